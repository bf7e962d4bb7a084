"""Column builders for the change and log rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new(key: str) -> Column:
    """Value of a column after the change; NULL when absent.

    `data` is a feed's map of columns, or the alias of a feed whose changes are
    typed rows (then Spark makes and reads only the columns in use).
    """
    return F.col(f"data.{key}")


def before(key: str) -> Column:
    """Value of a column before the change; NULL when the column did not change."""
    return F.col("old").getItem(key)


def is_type(*types: str) -> Column:
    return F.col("type").isin(*types)


def is_table(table: str, *types: str, database: str | None = None) -> Column:
    rule = F.col("table") == table
    if database:
        rule = rule & (F.col("database") == database)
    return rule & is_type(*types) if types else rule


def changed_to(key: str, value: str) -> Column:
    """An update touched `key` and it now holds `value`."""
    return is_type("update") & before(key).isNotNull() & (new(key) == value)


def transition(key: str, old: str, value: str) -> Column:
    """An update moved `key` from `old` to `value`."""
    return is_type("update") & (before(key) == old) & (new(key) == value)


def grew(key: str) -> Column:
    """An update raised the number in `key`."""
    return is_type("update") & (new(key).try_cast("int") > before(key).try_cast("int"))


def growth(key: str) -> Column:
    """Number newly added: the value of an insert, else the rise, as text."""
    rise = (new(key).try_cast("int") - before(key).try_cast("int")).cast("string")
    return F.when(is_type("insert"), new(key)).otherwise(rise)


# --- page log --------------------------------------------------------------
def entry_page() -> Column:
    return F.col("page.last_page_id").isNull()


def home_or_detail() -> Column:
    return F.col("page.page_id").isin("home", "good_detail")


def login_page() -> Column:
    last = F.col("page.last_page_id")
    return F.col("common.uid").isNotNull() & (last.isNull() | (last == "login"))


def keyword_search() -> Column:
    page = F.col("page")
    return (
        (page["last_page_id"] == "search")
        & (page["item_type"] == "keyword")
        & page["item"].isNotNull()
    )
