"""Layout settings of the two kinds of books, as values and as data.

Operators take a ``Profile``, whose settings are literals of the plan, or
``BY_BOOK``: then each row brings the settings of its book in a column, which
``with_settings`` joins to it, and books of any profiles go through one plan.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    name: str
    #: Font size to line prefix, in order; on ties the earlier one holds.  Fixed values.
    fonts: tuple[tuple[float, str], ...]
    top: float
    bottom: float | None
    detect: float
    indent: float
    centre: float
    #: Headings that follow a heading on the same page continue it.
    heading_continues: bool
    #: Indented lines and those that begin with a wide blank open a note too.
    indent_opens_note: bool
    #: The page's note region begins at a short rule, else at a text divider.
    rule_divides: bool


# Fixed values.
PROFILE_A = Profile("a", ((29.0, "# "), (16.6, "# "), (14.4, "# "), (13.0, "## "), (11.0, "### "), (7.4, "> ")), 110, 520, 40, 105, 120, True, False, True)
PROFILE_B = Profile("b", ((36.0, "# "), (26.0, "# "), (22.0, "# "), (18.0, "## "), (15.0, "SUBTITLE"), (14.0, "> ")), 80, None, 40, 75, 120, False, True, False)
TOLERANCE = 0.5
PROFILES = {p.name: p for p in (PROFILE_A, PROFILE_B)}

SETTINGS = "_settings"
_SCHEMA = f"profile string, {SETTINGS} struct<fonts: array<struct<size: double, prefix: string>>, top: double, bottom: double, detect: double, indent: double, centre: double, heading_continues: boolean, indent_opens_note: boolean, rule_divides: boolean>"


class ByBook:
    """Settings by name, as columns."""

    def __getattr__(self, name: str) -> Column:
        if name.startswith("__"):
            raise AttributeError(name)
        return F.col(f"{SETTINGS}.{name}")


BY_BOOK = ByBook()
Settings = Profile | ByBook


def with_settings(rows: DataFrame, books: DataFrame, profiles: dict[str, Profile] | None = None) -> DataFrame:
    """``rows`` with the settings of their book; ``books`` has doc_id and the name of its profile."""
    known = [{k: v for k, v in asdict(p).items() if k != "name"} | {"name": name} for name, p in (profiles or PROFILES).items()]
    data = [(p.pop("name"), p | {c: None if p[c] is None else float(p[c]) for c in ("top", "bottom", "detect", "indent", "centre")}) for p in known]
    table = rows.sparkSession.createDataFrame(data, _SCHEMA)  # a row for each profile
    return rows.join(books.select("doc_id", "profile").join(F.broadcast(table), "profile").drop("profile"), "doc_id")
