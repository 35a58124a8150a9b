"""One module per operator family; importing them fills the registry."""

from checks.families import (  # noqa: F401
    cleaning,
    conform,
    contract,
    enrich,
    quality,
    runs,
    sentiment,
    storage,
    transform,
)
