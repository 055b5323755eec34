"""Key parsing / building and scalar helpers as Column expressions (all
JVM-side, codegen'd; no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: table key pattern db://cluster.schema/table; greedy on the
# cluster so the last '.' before '/' splits cluster from schema.
TABLE_KEY_PATTERN = r"^(.*?)://(.*)\.(.*?)/(.*?)$"
# Fixed value: bookmark key pattern db.table.type.user.bookmark@cluster
BOOKMARK_PATTERN = r"^(.*?)\.(.*?)\.(.*?)\.(.*?)\.(.*?)@(.*?)$"


def parse_table_key(df: DataFrame, col: str) -> DataFrame:
    """Add database, cluster, schema, name parsed from a table key column.
    Non-matching keys give NULLs."""
    c = F.col(col)
    ok = c.rlike(TABLE_KEY_PATTERN)

    def part(i: int) -> Column:
        return F.when(ok, F.regexp_extract(c, TABLE_KEY_PATTERN, i))
    return df.select("*", part(1).alias("database"), part(2).alias("cluster"),
                     part(3).alias("schema"), part(4).alias("name"))


def build_table_key(database: Column, cluster: Column, schema: Column, name: Column) -> Column:
    return F.concat(database, F.lit("://"), cluster, F.lit("."), schema, F.lit("/"), name)


def parse_bookmark_key(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col)
    ok = c.rlike(BOOKMARK_PATTERN)
    names = ["database", "table", "entity_type", "user_id", "bookmark", "cluster"]
    return df.select("*", *[F.when(ok, F.regexp_extract(c, BOOKMARK_PATTERN, i + 1)).alias(n)
                            for i, n in enumerate(names)])


def epoch_trim(c: Column) -> Column:
    """First 10 digits of an epoch (ms -> s); NULL when shorter."""
    s = c.cast("string")
    return F.when(F.length(s) >= 10, F.substring(s, 1, 10).cast("long"))


def key_segment(c: Column, index: int, sep: str = "/") -> Column:
    """0-based positive or negative (from the end) segment of a key."""
    i = index + 1 if index >= 0 else index
    return F.element_at(F.split(c, sep if sep != "." else r"\."), i)


def dashboard_product(key: Column) -> Column:
    return F.substring_index(key, "_", 1)


def camel_to_words(c: Column) -> Column:
    """camelCase -> 'camel case'."""
    return F.lower(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2"))


def text_case(c: Column, mode: str) -> Column:
    if mode == "lower":
        return F.lower(c)
    if mode == "upper":
        return F.upper(c)
    if mode == "title":
        return F.initcap(c)
    if mode == "sentence":
        return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
    raise ValueError(mode)


def is_number(c: Column) -> Column:
    return c.cast("string").try_cast("double").isNotNull()


# Nested column type prefixes (hive / presto).
NESTED_TYPE_PREFIXES = {"hive": ["array", "map", "struct", "uniontype"],
                        "presto": ["array", "map", "row"]}


def is_nested_type(col_type: Column, dialect: str = "hive") -> Column:
    """Type string starts with a nested-type keyword and is longer than it."""
    t = F.lower(F.trim(col_type))
    conds = [t.startswith(p) & (F.length(t) > len(p)) for p in NESTED_TYPE_PREFIXES[dialect]]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def top_level_type(col_type: Column) -> Column:
    """Leading type keyword: 'array<..>' -> 'array', 'varchar(55)' -> 'varchar'."""
    return F.regexp_extract(F.lower(F.trim(col_type)), r"^([a-z_ ]+)", 1)
