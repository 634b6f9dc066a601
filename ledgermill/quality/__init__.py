"""Named data-quality rules and their summary."""
from ledgermill.quality.contract import Rule, registry  # noqa: F401
from ledgermill.quality import filings, facts, metrics, raw  # noqa: F401  (fill the registry)
