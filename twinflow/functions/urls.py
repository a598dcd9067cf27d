"""Digital-twin addresses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinflow.functions.text import strip

# The schemes an address may have.
SCHEMES = ("http", "https", "ftp")


_HOST = r"(?:\[[0-9A-Fa-f:.]++\]|[^\s/?#@:\[\]]++)"
_URL = rf"(?i)^(?:{'|'.join(SCHEMES)})://(?:[^\s/?#@]*+@)?+{_HOST}(?::\d*+)?+(?:[/?#]\S*+)?+$"


def is_url(url: Column) -> Column:
    """Scheme, host and no blank inside; blanks around are no part of it.

    A host may be any name a resolver could know, underscores included.
    """
    return F.coalesce(strip(url).rlike(_URL), F.lit(False))


def normalize_url(url: Column) -> Column:
    """Trimmed, scheme in lower case; null when it is no URL."""
    text = strip(url)
    scheme = F.substring_index(text, "://", 1)
    rest = F.substr(text, F.length(scheme) + 1)
    return F.when(is_url(text), F.concat(F.lower(scheme), rest))
