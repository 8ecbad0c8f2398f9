"""All check queries. Importing this package registers them."""

from recordtide.plans.queries import (  # noqa: F401
    buffers,
    flagship,
    joins,
    mutations,
    nested,
    notifications,
    projections,
    reads,
    scalars,
    sets,
    streams,
)
