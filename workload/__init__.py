"""Every operator as a query over the driver tables, with its SQL counterpart."""

from workload import features, joins, models, profiles, roundtrips, scalars, spatial, study
from workload.common import REGISTRY

__all__ = ["REGISTRY", "features", "joins", "models", "profiles", "roundtrips", "scalars", "spatial", "study"]
