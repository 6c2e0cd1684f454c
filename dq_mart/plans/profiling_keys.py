"""Keys of SURVEY sections 2.5 (J2/J3) and 2.14: profiling and integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import integrity as I
from ..operators import profiling as P
from ..operators.heavy_hitters import candidates_of, exact_top_k, top_k_state
from ..operators.inference import infer_types
from ..operators.profile_state import finish, merge_states, merged_profile, profile_state
from ..session import scratch_path
from ..sources.key_tables import key_integrity, kind_of, write_key_tables
from ..sources.catalog import DRIVER_TABLES, row_counts, union_all
from .oracles import (ORACLES, bi_sql, bigint0_sql, dt_sql, mm_sql, nt_sql,
                      pct_sql, strip_sql, yn_sql)
from .registry import query
from .standins import (DriverTables, dirty_bigint, dirty_date,
                       dirty_null_token, dirty_yes_no, mismatch_pair)

CATALOG = DRIVER_TABLES


def customer_nt(t: DriverTables) -> DataFrame:
    """customer with a dirty text column, as the reader would give it
    (null tokens already null)."""
    c = t.customer
    raw = c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                   dirty_null_token(c.c_custkey, c.c_mktsegment).alias("segment"))
    return C.normalize_null_tokens(raw, ["segment"])


def orders_mm(t: DriverTables) -> DataFrame:
    o = t.orders
    a, b = mismatch_pair(o.o_orderkey, o.o_orderstatus)
    return o.select("o_orderkey", a.alias("requested"), b.alias("consulted"))


def profiled_columns(t: DriverTables) -> dict[str, Column]:
    """The columns of orders that the report profiles."""
    o = t.orders
    k = o.o_orderkey
    clean_yn = (F.when(o.o_orderstatus == "F", "Yes").when(o.o_orderstatus == "O", "No")
                .otherwise(" no"))
    return {"o_orderkey": k, "o_totalprice": o.o_totalprice, "o_orderdate": o.o_orderdate,
            "yn_raw": dirty_yes_no(k), "yn_clean": clean_yn,
            "dt_raw": dirty_date(k, o.o_orderdate),
            "dt_clean": o.o_orderdate.cast("date").cast("string"),
            "bi": C.bigint_or_zero(dirty_bigint(k)),
            # odd ids above 2^53, which no double holds
            "wide_id": k * 2 + F.lit(9007199254740993)}


def orders_profiled(t: DriverTables) -> DataFrame:
    return t.orders.select(*[c.alias(n) for n, c in profiled_columns(t).items()])


def counted_tables(t: DriverTables) -> dict[str, DataFrame]:
    """All tables, and one that a predicate leaves empty."""
    return {**{n: t.table(n) for n in CATALOG}, "empty": t.region.where("r_regionkey < 0")}


@query("catalog_row_counts")
def _catalog_row_counts(t: DriverTables) -> DataFrame:
    return row_counts(counted_tables(t))


@query("profile_nulls")
def _profile_nulls(t: DriverTables) -> DataFrame:
    return (P.profile_nulls(customer_nt(t), "customer")
            .unionByName(P.profile_nulls(orders_mm(t), "orders")))


@query("profile_types")
def _profile_types(t: DriverTables) -> DataFrame:
    return P.profile_types(customer_nt(t), "customer", "c_custkey")


def orders_text(t: DriverTables) -> DataFrame:
    """orders as raw text: clean columns of each kind, one of nulls only, and
    columns that one odd value in many makes text or another number type."""
    o = t.orders
    k = o.o_orderkey
    text = {
        "key": k.cast("string"), "wide": (k * 2 + F.lit(9007199254740993)).cast("string"),
        "huge": F.concat(k.cast("string"), F.lit("00000000000000000000")),
        "money": o.o_totalprice.cast("decimal(12,2)").cast("string"),
        "padded": F.concat(F.lit(" 00"), (k % 7).cast("string"), F.lit(" ")),
        "flag": F.when(k % 3 == 0, "True").when(k % 3 == 1, "false"),
        "day": o.o_orderdate.cast("date").cast("string"),
        "mixed": F.when(k % 2 == 0, (k % 5).cast("string")).otherwise(
            F.concat((k % 100).cast("string"), F.lit("."), (k % 8).cast("string"), F.lit("25"))),
        "exponent": F.when(k % 64 == 1, "1e3").otherwise((k % 5).cast("string")),
        "odd_flag": F.when(k % 64 == 1, "1").otherwise("true"),
        "dirty_date": dirty_date(k, o.o_orderdate), "dirty_id": dirty_bigint(k),
        "none": F.lit(None).cast("string"), "priority": o.o_orderpriority,
    }
    return o.select("o_orderkey", *[c.alias(n) for n, c in text.items()])


@query("profile_inferred_types")
def _profile_inferred_types(t: DriverTables) -> DataFrame:
    return infer_types(orders_text(t), "orders", "o_orderkey")


@query("profile_merged")
def _profile_merged(t: DriverTables) -> DataFrame:
    """The profile of orders from the stored states of all years but the last
    and that of the last year alone; distinct values by merged sketches, held
    against exact counts."""
    raw, o = orders_text(t), t.orders
    raw = raw.join(o.select("o_orderkey", F.year("o_orderdate").alias("__year")), "o_orderkey")
    cols = [c for c in raw.columns if c not in ("o_orderkey", "__year")]
    last = raw.select(F.max("__year")).scalar()
    path = scratch_path(t.spark, "profile_states")
    old = raw.where(F.col("__year") < last)
    profile_state(old, "orders", "o_orderkey", cols, F.col("__year")).write.parquet(path)
    new = profile_state(raw.where(F.col("__year") == last), "orders", "o_orderkey", cols, F.col("__year"))
    states = merged_profile(t.spark.read.parquet(path), new)
    out = finish(merge_states(states))
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in cols])
    exact = raw.select(F.explode(values).alias("e")).select("e.*").distinct().groupBy("column_name") \
        .agg(F.count("v").alias("distinct_values"))
    dated = F.col("column_name").isin("day", "dirty_date")
    return out.join(exact, "column_name").select(
        "table_name", "column_name", "dtype", "sample", "widest", "rows", "missing", "missing_pct",
        "max_value", "needs_bigint", F.when(dated, F.col("bad_dates")).alias("bad_dates"),
        F.when(dated, F.col("min_date")).alias("min_date"), F.when(dated, F.col("max_date")).alias("max_date"),
        "unexpected", "yes_count", "no_count", "distinct_values",
        (F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= 0.08 * F.col("distinct_values"))
        .alias("estimate_close"))


@query("top_values_sketched")
def _top_values_sketched(t: DriverTables) -> DataFrame:
    """The ten most frequent values of columns with few, many and only distinct
    values; the sketches of the second are stored for each line number and
    combined."""
    li = t.lineitem
    path = scratch_path(t.spark, "top_k_states")
    top_k_state(li, "l_partkey", F.col("l_linenumber")).write.parquet(path)
    parts = candidates_of(t.spark.read.parquet(path), 40)
    found = {"l_suppkey": exact_top_k(li, "l_suppkey", 10), "l_partkey": exact_top_k(li, "l_partkey", 10, parts),
             "o_comment_key": exact_top_k(t.orders.select(F.col("o_orderkey").alias("o_comment_key")),
                                          "o_comment_key", 10),
             "l_shipmode": exact_top_k(li.select((F.col("l_orderkey") % 7).alias("l_shipmode")), "l_shipmode", 10)}
    return union_all(df.select(F.lit(c).alias("column_name"), F.col("value").cast("string").alias("value"), "cnt")
                     for c, df in found.items())


@query("profile_int_range")
def _profile_int_range(t: DriverTables) -> DataFrame:
    return P.profile_int_range(orders_profiled(t), "orders")


@query("profile_categorical")
def _profile_categorical(t: DriverTables) -> DataFrame:
    return P.profile_categorical(customer_nt(t), "customer",
                                 ["segment", "c_nationkey", "Anesthesia Type"])


@query("profile_dates")
def _profile_dates(t: DriverTables) -> DataFrame:
    return P.profile_dates(orders_profiled(t), "orders", ["dt_raw", "dt_clean", "o_orderdate"])


@query("profile_dates_bad_values")
def _profile_dates_bad_values(t: DriverTables) -> DataFrame:
    return P.profile_dates_bad_values(orders_profiled(t), "orders", "dt_raw", "o_orderkey")


@query("profile_yes_no")
def _profile_yes_no(t: DriverTables) -> DataFrame:
    return P.profile_yes_no(orders_profiled(t), "orders", ["yn_raw", "yn_clean"])


@query("profile_yes_no_unexpected")
def _profile_yes_no_unexpected(t: DriverTables) -> DataFrame:
    return P.profile_yes_no_unexpected(orders_profiled(t), "orders", ["yn_raw", "yn_clean"])


@query("profile_mismatch")
def _profile_mismatch(t: DriverTables) -> DataFrame:
    return P.profile_mismatch(orders_mm(t), "requested", "consulted")


def lineitem_dirty_fk(t: DriverTables) -> DataFrame:
    """lineitem with a dirty order key: some nulls and some keys that no
    order has."""
    li = t.lineitem
    k = li.l_orderkey
    dirty = (F.when(k % 50 == 0, F.lit(None).cast("bigint"))
             .when(k % 97 == 0, k + F.lit(10000000)).otherwise(k))
    return li.select(dirty.alias("l_orderkey"), "l_partkey", "l_suppkey")


def driver_fks(t: DriverTables) -> list[I.ForeignKey]:
    """Eight relationships, like the reference's eight checks, then keys of
    different kinds and an empty child."""
    li = lineitem_dirty_fk(t)
    o, c, p, s, n, r, e = (t.orders, t.customer, t.part, t.supplier, t.nation,
                           t.region, t.events)
    return [
        I.ForeignKey("lineitem.l_orderkey -> orders.o_orderkey", li, "l_orderkey", o, "o_orderkey"),
        I.ForeignKey("orders.o_custkey -> customer.c_custkey", o, "o_custkey", c, "c_custkey"),
        I.ForeignKey("lineitem.l_partkey -> part.p_partkey", li, "l_partkey", p, "p_partkey"),
        I.ForeignKey("lineitem.l_suppkey -> supplier.s_suppkey", li, "l_suppkey", s, "s_suppkey"),
        I.ForeignKey("customer.c_nationkey -> nation.n_nationkey", c, "c_nationkey", n, "n_nationkey"),
        I.ForeignKey("supplier.s_nationkey -> nation.n_nationkey", s, "s_nationkey", n, "n_nationkey"),
        I.ForeignKey("nation.n_regionkey -> region.r_regionkey", n, "n_regionkey", r, "r_regionkey"),
        I.ForeignKey("events.user_id -> customer.c_custkey", e, "user_id", c, "c_custkey"),
        # keys of different kinds: text (some no number) and fractions
        I.ForeignKey("text supplier -> supplier.s_suppkey",
                     s.select(F.when(s.s_suppkey % 7 == 0, "zz").when(s.s_suppkey % 5 == 0, F.concat(
                         s.s_suppkey.cast("string"), F.lit(".0"))).when(s.s_suppkey % 11 == 0, F.concat(
                             s.s_suppkey.cast("string"), F.lit(".00000000001"))).when(
                         s.s_suppkey % 13 == 0, F.concat(F.lit("00"), s.s_suppkey.cast("string")))
                         .otherwise(s.s_suppkey.cast("string")).alias("k")), "k", s, "s_suppkey"),
        I.ForeignKey("half part -> part.p_partkey",
                     p.select((p.p_partkey / 2).alias("k")), "k", p, "p_partkey"),
        I.ForeignKey("no region -> region.r_regionkey", r.where("r_regionkey < 0"), "r_regionkey",
                     r, "r_regionkey"),
    ]


@query("fk_integrity")
def _fk_integrity(t: DriverTables) -> DataFrame:
    return I.fk_integrity(driver_fks(t))


@query("fk_integrity_keys")
def _fk_integrity_keys(t: DriverTables) -> DataFrame:
    """The same checks from key tables, with the rows that orphans hold."""
    checks = driver_fks(t)
    tables = write_key_tables(checks, scratch_path(t.spark, "key_tables"), buckets=8)
    pairs = {}
    for fk in checks:
        kind = kind_of(fk.child.schema[fk.child_col].dataType, fk.parent.schema[fk.parent_col].dataType)
        pairs[fk.label] = (tables[(id(fk.child), fk.child_col, kind)], tables[(id(fk.parent), fk.parent_col, kind)])
    return key_integrity(t.spark, pairs)


@query("fk_orphans")
def _fk_orphans(t: DriverTables) -> DataFrame:
    return I.fk_orphans(driver_fks(t))


# --- oracles -------------------------------------------------------------------

ORACLES["catalog_row_counts"] = " UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {n}"
     for n in CATALOG] + ["SELECT 'empty', CAST(0 AS BIGINT)"]
    + ["SELECT 'TOTAL' AS table_name, CAST(("
       + " + ".join(f"(SELECT COUNT(*) FROM {n})" for n in CATALOG) + ") AS BIGINT)"])

_CUSTOMER_NT = f"""(SELECT c_custkey, c_name, c_nationkey, c_acctbal,
   CASE WHEN v IN ('None', 'NA', '') THEN NULL ELSE v END AS segment
   FROM (SELECT *, {nt_sql('c_custkey', 'c_mktsegment')} AS v FROM customer))"""

_mm_a, _mm_b = mm_sql("o_orderkey", "o_orderstatus")
_ORDERS_MM = f"(SELECT o_orderkey, {_mm_a} AS requested, {_mm_b} AS consulted FROM orders)"


def _blank(v: str) -> str:
    return f"({v} IS NULL OR {strip_sql(v)} = '')"


ORACLES["profile_nulls"] = f"""
WITH c AS (SELECT COUNT(*) AS n,
                  COUNT(*) FILTER (WHERE {_blank('c_name')}) AS c_name,
                  COUNT(*) FILTER (WHERE {_blank('segment')}) AS segment,
                  COUNT(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey,
                  COUNT(*) FILTER (WHERE c_nationkey IS NULL) AS c_nationkey,
                  COUNT(*) FILTER (WHERE c_acctbal IS NULL OR isnan(c_acctbal)) AS c_acctbal
           FROM {_CUSTOMER_NT} x),
     o AS (SELECT COUNT(*) AS n,
                  COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey,
                  COUNT(*) FILTER (WHERE {_blank('requested')}) AS requested,
                  COUNT(*) FILTER (WHERE {_blank('consulted')}) AS consulted
           FROM {_ORDERS_MM} y),
     u AS (
  SELECT 'customer' AS table_name, 'c_custkey' AS column_name, c_custkey AS k, n FROM c UNION ALL
  SELECT 'customer', 'c_name', c_name, n FROM c UNION ALL
  SELECT 'customer', 'c_nationkey', c_nationkey, n FROM c UNION ALL
  SELECT 'customer', 'c_acctbal', c_acctbal, n FROM c UNION ALL
  SELECT 'customer', 'segment', segment, n FROM c UNION ALL
  SELECT 'orders', 'o_orderkey', o_orderkey, n FROM o UNION ALL
  SELECT 'orders', 'requested', requested, n FROM o UNION ALL
  SELECT 'orders', 'consulted', consulted, n FROM o)
SELECT table_name, column_name, CAST(k AS BIGINT) AS null_count, {pct_sql('k', 'n', 1)} AS pct
FROM u WHERE k > 0"""

_TYPE_NAME = """CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date'
  WHEN 'BOOLEAN' THEN 'boolean' ELSE lower({t}) END"""

ORACLES["profile_types"] = f"""
WITH f AS (SELECT * FROM {_CUSTOMER_NT} x ORDER BY c_custkey LIMIT 1)
SELECT 'customer' AS table_name, column_name,
       {_TYPE_NAME.format(t='dtype')} AS dtype, sample FROM (
  SELECT 'c_custkey' AS column_name, typeof(c_custkey) AS dtype, CAST(c_custkey AS VARCHAR) AS sample FROM f UNION ALL
  SELECT 'c_name', 'VARCHAR', CAST(c_name AS VARCHAR) FROM f UNION ALL
  SELECT 'c_nationkey', typeof(c_nationkey), CAST(c_nationkey AS VARCHAR) FROM f UNION ALL
  SELECT 'c_acctbal', typeof(c_acctbal), CAST(c_acctbal AS VARCHAR) FROM f UNION ALL
  SELECT 'segment', 'VARCHAR', CAST(segment AS VARCHAR) FROM f)"""

_TEXT_COLUMNS = {
    "key": "CAST(o_orderkey AS VARCHAR)", "wide": "CAST(o_orderkey * 2 + 9007199254740993 AS VARCHAR)",
    "huge": "CAST(o_orderkey AS VARCHAR) || '00000000000000000000'",
    "money": "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)",
    "padded": "' 00' || CAST(o_orderkey % 7 AS VARCHAR) || ' '",
    "flag": "CASE WHEN o_orderkey % 3 = 0 THEN 'True' WHEN o_orderkey % 3 = 1 THEN 'false' END",
    "day": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)",
    "mixed": "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 5 AS VARCHAR) ELSE "
             "CAST(o_orderkey % 100 AS VARCHAR) || '.' || CAST(o_orderkey % 8 AS VARCHAR) || '25' END",
    "exponent": "CASE WHEN o_orderkey % 64 = 1 THEN '1e3' ELSE CAST(o_orderkey % 5 AS VARCHAR) END",
    "odd_flag": "CASE WHEN o_orderkey % 64 = 1 THEN '1' ELSE 'true' END",
    "dirty_date": dt_sql("o_orderkey", "o_orderdate"), "dirty_id": bi_sql("o_orderkey"),
    "none": "CAST(NULL AS VARCHAR)", "priority": "o_orderpriority",
}


def _inferred_types_sql() -> str:
    """Types tried from the narrowest: all values of a column must fit."""
    values = " UNION ALL ".join(f"SELECT o_orderkey AS k, '{n}' AS column_name, {e} AS raw FROM orders"
                                for n, e in _TEXT_COLUMNS.items())
    number = r"'[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)'"
    return rf"""
WITH v AS ({values}),
p AS (SELECT *, trim(raw) AS t, regexp_full_match(trim(raw), {number}) AS plain FROM v),
d AS (
  SELECT *, CASE WHEN plain THEN length(ltrim(split_part(ltrim(t, '+-'), '.', 1), '0')) END AS whole,
         CASE WHEN plain THEN length(split_part(t, '.', 2)) END AS scale FROM p),
g AS (
  SELECT column_name, count(raw) AS n, max(whole) AS whole, max(scale) AS scale,
         bool_and(lower(t) IN ('true', 'false')) AS all_bool,
         bool_and(regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(t AS DATE) IS NOT NULL) AS all_date,
         bool_and(plain AND NOT contains(t, '.')) AS all_whole,
         bool_and(plain) AS all_plain,
         bool_and(plain OR regexp_full_match(t, {number[:-1]}[eE][+-]?[0-9]+')) AS all_number,
         bool_and(TRY_CAST(t AS INTEGER) IS NOT NULL) AS fits_int,
         bool_and(TRY_CAST(t AS BIGINT) IS NOT NULL) AS fits_big,
         max(length(raw)) AS max_length, min(raw) FILTER (WHERE length(raw) = m) AS widest,
         arg_min_null(raw, k) AS sample
  FROM (SELECT *, max(length(raw)) OVER (PARTITION BY column_name) AS m FROM d) GROUP BY column_name)
SELECT 'orders' AS table_name, column_name, CASE
    WHEN n = 0 THEN 'void' WHEN all_bool THEN 'boolean' WHEN all_date THEN 'date'
    WHEN all_whole AND fits_int THEN 'int' WHEN all_whole AND fits_big THEN 'bigint'
    WHEN all_plain AND whole + scale <= 38 THEN 'decimal(' || greatest(whole + scale, 1) || ',' || scale || ')'
    WHEN all_number THEN 'double' ELSE 'string' END AS dtype,
  sample, widest, max_length, n AS non_null
FROM g"""


ORACLES["profile_inferred_types"] = _inferred_types_sql()


def _profile_merged_sql() -> str:
    """Everything from all rows at once."""
    values = " UNION ALL ".join(f"SELECT o_orderkey AS k, '{n}' AS column_name, {e} AS raw FROM orders"
                                for n, e in _TEXT_COLUMNS.items())
    text = strip_sql("raw")
    return rf"""
WITH types AS ({_inferred_types_sql()}),
v AS ({values}),
g AS (
  SELECT column_name, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {_blank('raw')}) AS missing,
         MAX(CASE WHEN NOT contains(lower(raw), 'e') THEN TRY_CAST({text} AS DECIMAL(38,6)) END) AS num,
         MAX(CASE WHEN contains(lower(raw), 'e') THEN TRY_CAST({text} AS DOUBLE) END) AS dbl,
         COUNT(*) FILTER (WHERE TRY_CAST(raw AS DATE) IS NULL) AS bad,
         MIN(TRY_CAST(raw AS DATE)) AS lo, MAX(TRY_CAST(raw AS DATE)) AS hi,
         COUNT(*) FILTER (WHERE raw IS NULL OR lower({text}) NOT IN ('yes', 'no')) AS unexpected,
         COUNT(DISTINCT raw) AS distinct_values
  FROM v GROUP BY column_name),
m AS (
  SELECT g.*, t.dtype, t.sample, t.widest, coalesce(dbl > coalesce(CAST(num AS DOUBLE), 0), false) AS beyond,
         t.dtype IN ('int', 'bigint', 'double') OR t.dtype LIKE 'decimal%' AS numeric_column,
         g.column_name IN ('day', 'dirty_date') AS dated
  FROM g JOIN types t USING (column_name))
SELECT 'orders' AS table_name, column_name, dtype, sample, widest, CAST(rows AS BIGINT) AS rows,
       CAST(missing AS BIGINT) AS missing, {pct_sql('missing', 'rows', 1)} AS missing_pct,
       CASE WHEN numeric_column THEN CASE WHEN beyond THEN CAST(dbl AS VARCHAR)
            ELSE regexp_replace(CAST(num AS VARCHAR), '\.0+$', '') END END AS max_value,
       CASE WHEN numeric_column THEN beyond OR num > 2147483647 END AS needs_bigint,
       CASE WHEN dated THEN bad END AS bad_dates, CASE WHEN dated AND bad = 0 THEN lo END AS min_date,
       CASE WHEN dated AND bad = 0 THEN hi END AS max_date, CAST(unexpected AS BIGINT) AS unexpected,
       CASE WHEN unexpected = 0 THEN CAST(0 AS BIGINT) END AS yes_count,
       CASE WHEN unexpected = 0 THEN CAST(0 AS BIGINT) END AS no_count,
       CAST(distinct_values AS BIGINT) AS distinct_values, true AS estimate_close
FROM m"""


ORACLES["top_values_sketched"] = " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, CAST(v AS VARCHAR) AS value, CAST(COUNT(*) AS BIGINT) AS cnt "
    f"FROM (SELECT {e} AS v FROM {src}) GROUP BY v ORDER BY COUNT(*) DESC, v LIMIT 10)"
    for c, e, src in (("l_suppkey", "l_suppkey", "lineitem"), ("l_partkey", "l_partkey", "lineitem"),
                      ("o_comment_key", "o_orderkey", "orders"), ("l_shipmode", "l_orderkey % 7", "lineitem")))

ORACLES["profile_merged"] = _profile_merged_sql()

_ORDERS_PROFILED = f"""(SELECT o_orderkey, o_totalprice, o_orderdate,
   {yn_sql('o_orderkey')} AS yn_raw,
   CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'No' ELSE ' no' END AS yn_clean,
   {dt_sql('o_orderkey', 'o_orderdate')} AS dt_raw,
   CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt_clean,
   {bigint0_sql(bi_sql('o_orderkey'))} AS bi, o_orderkey * 2 + 9007199254740993 AS wide_id
   FROM orders)"""

ORACLES["profile_int_range"] = f"""
WITH m AS (SELECT MAX(o_orderkey) AS a, MAX(o_totalprice) AS b, MAX(bi) AS c, MAX(wide_id) AS d
           FROM {_ORDERS_PROFILED} p)
SELECT 'orders' AS table_name, column_name, max_value, COALESCE(large, false) AS needs_bigint FROM (
  SELECT 'o_orderkey' AS column_name, CAST(a AS VARCHAR) AS max_value, a > 2147483647 AS large FROM m UNION ALL
  SELECT 'o_totalprice', CAST(CAST(b AS DECIMAL(38,6)) AS VARCHAR), b > 2147483647 FROM m UNION ALL
  SELECT 'bi', CAST(c AS VARCHAR), c > 2147483647 FROM m UNION ALL
  SELECT 'wide_id', CAST(d AS VARCHAR), d > 2147483647 FROM m)"""

ORACLES["profile_categorical"] = f"""
WITH x AS (SELECT * FROM {_CUSTOMER_NT} c), t AS (SELECT COUNT(*) AS n FROM x),
     v AS (SELECT 'segment' AS column_name, segment AS value FROM x UNION ALL
           SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM x)
SELECT 'customer' AS table_name, column_name, value, CAST(COUNT(*) AS BIGINT) AS cnt,
       {pct_sql('COUNT(*)', 'MAX(t.n)', 1)} AS pct, 'ok' AS status
FROM v, t WHERE value IS NOT NULL GROUP BY column_name, value
UNION ALL
SELECT 'customer', 'Anesthesia Type', NULL, NULL, NULL, 'missing'"""

ORACLES["profile_dates"] = f"""
WITH p AS (SELECT TRY_CAST(dt_raw AS DATE) AS a, TRY_CAST(dt_clean AS DATE) AS b,
                  CAST(o_orderdate AS DATE) AS c FROM {_ORDERS_PROFILED} x),
     s AS (SELECT COUNT(*) FILTER (WHERE a IS NULL) AS ba, MIN(a) AS la, MAX(a) AS ha,
                  COUNT(*) FILTER (WHERE b IS NULL) AS bb, MIN(b) AS lb, MAX(b) AS hb,
                  COUNT(*) FILTER (WHERE c IS NULL) AS bc, MIN(c) AS lc, MAX(c) AS hc FROM p)
SELECT 'orders' AS table_name, column_name, CAST(bad AS BIGINT) AS bad_count,
       CASE WHEN bad = 0 THEN lo END AS min_date, CASE WHEN bad = 0 THEN hi END AS max_date FROM (
  SELECT 'dt_raw' AS column_name, ba AS bad, la AS lo, ha AS hi FROM s UNION ALL
  SELECT 'dt_clean', bb, lb, hb FROM s UNION ALL
  SELECT 'o_orderdate', bc, lc, hc FROM s)"""

ORACLES["profile_dates_bad_values"] = f"""
SELECT 'orders' AS table_name, 'dt_raw' AS column_name, dt_raw AS bad_value
FROM {_ORDERS_PROFILED} p WHERE TRY_CAST(dt_raw AS DATE) IS NULL
GROUP BY dt_raw ORDER BY MIN(o_orderkey) LIMIT 5"""

_YN_VALUES = f"""(SELECT 'yn_raw' AS column_name, yn_raw AS raw FROM {_ORDERS_PROFILED} p UNION ALL
   SELECT 'yn_clean', yn_clean FROM {_ORDERS_PROFILED} q)"""

ORACLES["profile_yes_no_unexpected"] = f"""
SELECT DISTINCT 'orders' AS table_name, column_name, lower({strip_sql('raw')}) AS unexpected_value
FROM {_YN_VALUES} v
WHERE raw IS NULL OR lower({strip_sql('raw')}) NOT IN ('yes', 'no')"""

ORACLES["profile_yes_no"] = f"""
WITH u AS (
  SELECT column_name, CAST(COUNT(DISTINCT lower({strip_sql('raw')})) FILTER
            (WHERE lower({strip_sql('raw')}) NOT IN ('yes', 'no'))
          + MAX(CASE WHEN raw IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unexpected_count,
         CAST(COUNT(*) FILTER (WHERE lower(raw) = 'yes') AS BIGINT) AS y,
         CAST(COUNT(*) FILTER (WHERE lower(raw) = 'no') AS BIGINT) AS n
  FROM {_YN_VALUES} v GROUP BY column_name)
SELECT 'orders' AS table_name, column_name,
       CASE WHEN unexpected_count = 0 THEN y END AS yes_count,
       CASE WHEN unexpected_count = 0 THEN n END AS no_count, unexpected_count FROM u"""

ORACLES["profile_mismatch"] = f"""
WITH m AS (SELECT CAST(COUNT(*) FILTER (WHERE requested IS DISTINCT FROM consulted
                                           OR requested IS NULL) AS BIGINT) AS mismatches,
                  CAST(COUNT(*) AS BIGINT) AS total FROM {_ORDERS_MM} x)
SELECT mismatches, total, {pct_sql('mismatches', 'total', 1)} AS pct,
       mismatches = total AS all_mismatch FROM m"""

_FK_SQL = [
    ("lineitem.l_orderkey -> orders.o_orderkey",
     "SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey % 97 = 0 "
     "THEN l_orderkey + 10000000 ELSE l_orderkey END AS k FROM lineitem",
     "SELECT o_orderkey AS k FROM orders"),
    ("orders.o_custkey -> customer.c_custkey", "SELECT o_custkey AS k FROM orders",
     "SELECT c_custkey AS k FROM customer"),
    ("lineitem.l_partkey -> part.p_partkey", "SELECT l_partkey AS k FROM lineitem",
     "SELECT p_partkey AS k FROM part"),
    ("lineitem.l_suppkey -> supplier.s_suppkey", "SELECT l_suppkey AS k FROM lineitem",
     "SELECT s_suppkey AS k FROM supplier"),
    ("customer.c_nationkey -> nation.n_nationkey", "SELECT c_nationkey AS k FROM customer",
     "SELECT n_nationkey AS k FROM nation"),
    ("supplier.s_nationkey -> nation.n_nationkey", "SELECT s_nationkey AS k FROM supplier",
     "SELECT n_nationkey AS k FROM nation"),
    ("nation.n_regionkey -> region.r_regionkey", "SELECT n_regionkey AS k FROM nation",
     "SELECT r_regionkey AS k FROM region"),
    ("events.user_id -> customer.c_custkey", "SELECT user_id AS k FROM events",
     "SELECT c_custkey AS k FROM customer"),
]
# keys of different kinds, compared as numbers where they are numbers
# (whole numbers with a zero fraction as themselves, leading zeros as text)
_TEXT_KEY = ("CASE WHEN s_suppkey % 7 = 0 THEN 'zz' WHEN s_suppkey % 5 = 0 THEN CAST(s_suppkey AS VARCHAR) "
             "WHEN s_suppkey % 11 = 0 THEN CAST(s_suppkey AS VARCHAR) || '.00000000001' "
             "WHEN s_suppkey % 13 = 0 THEN '00' || CAST(s_suppkey AS VARCHAR) "
             "ELSE CAST(s_suppkey AS VARCHAR) END")
_HALF_KEY = ("CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey // 2 AS VARCHAR) "
             "ELSE CAST(p_partkey // 2 AS VARCHAR) || '.5' END")
_FK_SQL += [
    ("text supplier -> supplier.s_suppkey", f"SELECT {_TEXT_KEY} AS k FROM supplier",
     "SELECT CAST(s_suppkey AS VARCHAR) AS k FROM supplier"),
    ("half part -> part.p_partkey", f"SELECT {_HALF_KEY} AS k FROM part",
     "SELECT CAST(p_partkey AS VARCHAR) AS k FROM part"),
    ("no region -> region.r_regionkey", "SELECT r_regionkey AS k FROM region WHERE r_regionkey < 0",
     "SELECT r_regionkey AS k FROM region"),
]


def _orphans_sql(child: str, parent: str) -> str:
    return (f"SELECT DISTINCT c.k FROM ({child}) c WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({parent}) p WHERE p.k IS NOT DISTINCT FROM c.k)")


ORACLES["fk_orphans"] = " UNION ALL ".join(
    f"SELECT '{label}' AS label, CAST(k AS VARCHAR) AS orphan FROM ({_orphans_sql(c, p)}) o"
    for label, c, p in _FK_SQL)

ORACLES["fk_integrity_keys"] = " UNION ALL ".join(
    f"""SELECT '{label}' AS label,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT k FROM ({c}) c0)) AS BIGINT) AS child_ids,
       CAST((SELECT COUNT(*) FROM ({_orphans_sql(c, p)}) o1) AS BIGINT) AS orphans,
       (SELECT string_agg(COALESCE(CAST(k AS VARCHAR), 'NULL'), ', ' ORDER BY k NULLS FIRST)
          FROM (SELECT k FROM ({_orphans_sql(c, p)}) o2 ORDER BY k NULLS FIRST LIMIT 5) o3) AS examples,
       CAST((SELECT COUNT(*) FROM ({c}) c1) AS BIGINT) AS child_rows,
       CAST((SELECT COUNT(*) FROM ({c}) c2 WHERE NOT EXISTS (SELECT 1 FROM ({p}) p2
             WHERE p2.k IS NOT DISTINCT FROM c2.k)) AS BIGINT) AS orphan_rows"""
    for label, c, p in _FK_SQL)

ORACLES["fk_integrity"] = " UNION ALL ".join(
    f"""SELECT '{label}' AS label,
       CAST((SELECT COUNT(*) FROM (SELECT DISTINCT k FROM ({c}) c0)) AS BIGINT) AS child_ids,
       CAST((SELECT COUNT(*) FROM ({_orphans_sql(c, p)}) o1) AS BIGINT) AS orphans,
       (SELECT string_agg(COALESCE(CAST(k AS VARCHAR), 'NULL'), ', ' ORDER BY k NULLS FIRST)
          FROM (SELECT k FROM ({_orphans_sql(c, p)}) o2 ORDER BY k NULLS FIRST LIMIT 5) o3) AS examples"""
    for label, c, p in _FK_SQL)
