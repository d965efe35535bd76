"""Column names: quoting and cleaning."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_name(name: str) -> str:
    """Replace every character that is not a letter, digit or underscore by ``_``."""
    return re.sub(r"[^\w]", "_", name)


def require_unique(names: Iterable[str], action: str) -> None:
    """Raise, naming the culprits, if an operation would give two columns one name."""
    repeated = sorted(name for name, count in Counter(names).items() if count > 1)
    if repeated:
        raise ValueError(f"{action} gives duplicate column names: {', '.join(repeated)}")
