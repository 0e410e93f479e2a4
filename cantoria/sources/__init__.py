

from . import cuts, manifests  # noqa: F401  each registers its source types
