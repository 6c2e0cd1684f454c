"""Hospital roles played by the driver's TPC-H-like tables.

The reference's own CSVs are not shipped, so every operator is exercised on
the driver's Parquet tables, each column cast into a hospital role (see
FIXTURES.md section 3).  Dirty values are *derived* from each row's own key
(never by filtering rows), so every query still reads whole tables and its
work grows with them.  Each derivation here has a SQL twin in
``plans/oracles.py`` used by the DuckDB oracles.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import MONEY


#: The SQL twin of ``DriverTables.lineitem_appointments``.
APPOINTMENTS_SQL = """(SELECT CASE WHEN l_orderkey % 47 <> 0 THEN l_suppkey END AS branch_id,
        CASE WHEN l_orderkey % 31 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_of_consultation,
        CASE WHEN l_orderkey % 29 <> 0 THEN o_orderpriority END AS diagnosis,
        CASE WHEN l_orderkey % 11 <> 0 THEN l_partkey % 5 END AS requested_doctor_id,
        CASE WHEN l_orderkey % 13 <> 0 THEN l_suppkey % 5 END AS consulted_doctor_id
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


class DriverTables:
    """Lazy handles on ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One scan definition per table and query (the file listing and
        footer read happen once)."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    # --- role views used by the analytical queries ----------------------------

    @cached_property
    def order_visits(self) -> DataFrame:
        """orders as appointments: branch = priority (null for some), date =
        order date (null for some)."""
        o = self.orders
        return o.select(F.when(o.o_orderkey % 41 != 0, o.o_orderpriority).alias("branch_id"),
                        F.when(o.o_orderkey % 31 != 0, o.o_orderdate.cast("date"))
                        .alias("date_of_consultation"))

    @cached_property
    def part_diagnoses(self) -> DataFrame:
        """part as appointments: diagnosis = part name."""
        return self.part.select(F.col("p_name").alias("diagnosis"))

    @cached_property
    def lineitem_billing(self) -> DataFrame:
        """lineitem as billing by supplier: bill = extended price, covered =
        price x discount (exact, rounded to cents), the rest out of pocket."""
        li = self.lineitem
        bill = li.l_extendedprice.cast(MONEY)
        covered = F.round(bill * li.l_discount.cast("decimal(4,2)"), 2).cast(MONEY)
        return li.select(li.l_suppkey.alias("branch_id"),
                         bill.alias("total_bill"),
                         covered.alias("amount_covered"),
                         (bill - covered).cast(MONEY).alias("out_of_pocket_expenses"))

    @cached_property
    def order_billing(self) -> DataFrame:
        """orders x customer as billing: insurer = market segment, status from
        the order status, nulled for every 7th order key."""
        o, c = self.orders, self.customer
        status = (F.when(o.o_orderkey % 7 == 0, F.lit(None).cast("string"))
                  .when(o.o_orderstatus == "F", "Approved")
                  .when(o.o_orderstatus == "P", "Pending")
                  .when(o.o_orderstatus == "O", "Rejected"))
        j = o.join(c, o.o_custkey == c.c_custkey, "inner")
        return j.select(o.o_orderpriority.alias("branch_id"),
                        o.o_totalprice.alias("total_bill"),
                        c.c_mktsegment.alias("insurance_provider"),
                        status.alias("claim_status"))

    @cached_property
    def lineitem_surgeries(self) -> DataFrame:
        """lineitem as surgeries: doctor = supplier, outcome from return flag."""
        li = self.lineitem
        outcome = (F.when(li.l_returnflag == "A", "Successful")
                   .when(li.l_returnflag == "R", "Failed")
                   .when(li.l_returnflag == "N", "Complications"))
        return li.select(li.l_suppkey.alias("doctor_id"),
                         outcome.alias("surgery_outcome"))

    @cached_property
    def substitution_visits(self) -> DataFrame:
        """lineitem as appointments: requested doctor = the customer's nation,
        consulted doctor = the supplier's nation, branch = supplier nation;
        serial number, doctors and branch are null for some rows, and some
        branches are in no dimension."""
        li, o, c, s = self.lineitem, self.orders, self.customer, self.supplier
        j = (li.select("l_orderkey", "l_suppkey", "l_linenumber")
             .join(o.select("o_orderkey", "o_custkey"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .join(c.select("c_custkey", "c_nationkey"),
                   F.col("o_custkey") == F.col("c_custkey"))
             .join(s.select("s_suppkey", "s_nationkey"),
                   F.col("l_suppkey") == F.col("s_suppkey")))
        k, b = F.col("l_orderkey"), F.col("s_nationkey")
        return j.select(F.when(k % 19 != 0, F.col("l_linenumber")).alias("serial_no"),
                        F.when(k % 43 == 0, b + 100).when(k % 47 != 0, b).alias("branch_id"),
                        F.when(k % 11 != 0, F.col("c_nationkey")).alias("requested_doctor_id"),
                        F.when(k % 13 != 0, b).alias("consulted_doctor_id"))

    @cached_property
    def lineitem_appointments(self) -> DataFrame:
        """lineitem as appointments with all roles of the report: branch =
        supplier, date = order date, diagnosis = order priority (some null),
        requested doctor = part's, consulted doctor = the supplier's."""
        k, o = F.col("l_orderkey"), self.orders
        j = self.lineitem.select("l_orderkey", "l_suppkey", "l_partkey").join(
            o.select("o_orderkey", "o_orderdate", "o_orderpriority"), k == F.col("o_orderkey"))
        return j.select(F.when(k % 47 != 0, F.col("l_suppkey")).alias("branch_id"),
                        F.when(k % 31 != 0, F.col("o_orderdate").cast("date")).alias("date_of_consultation"),
                        F.when(k % 29 != 0, F.col("o_orderpriority")).alias("diagnosis"),
                        F.when(k % 11 != 0, F.col("l_partkey") % 5).alias("requested_doctor_id"),
                        F.when(k % 13 != 0, F.col("l_suppkey") % 5).alias("consulted_doctor_id"))

    @cached_property
    def nation_branches(self) -> DataFrame:
        """nation as branches; some share a location."""
        n = self.nation
        return n.select(n.n_nationkey.alias("branch_id"),
                        F.when(n.n_nationkey % 4 == 0, "SHARED").otherwise(n.n_name).alias("location"))


def key_case(key: Column, modulus: int, cases: dict[int, Column | str | None],
             default: Column | str | None) -> Column:
    """``CASE CAST(key % m AS INT) WHEN i THEN v_i ... ELSE default END`` —
    a per-row derivation of a dirty value from the row's own key."""
    r = (key % modulus).cast("int")
    expr = None
    for i, v in cases.items():
        v = v if isinstance(v, Column) else F.lit(v).cast("string")
        expr = F.when(r == i, v) if expr is None else expr.when(r == i, v)
    d = default if isinstance(default, Column) else F.lit(default).cast("string")
    return expr.otherwise(d)


# --- dirty derivations (FIXTURES.md 3.2); each is a function of the row's key --

def _s(v) -> Column:
    return F.lit(v).cast("string")


def dirty_yes_no(key: Column) -> Column:
    """YN: the yes/no spellings, a null and junk."""
    return key_case(key, 8, {0: "Yes", 1: " no ", 2: "TRUE", 3: "1", 4: None,
                             5: "NO", 6: F.concat(F.lit("\t"), F.lit("yes"))}, "maybe")


def dirty_date(key: Column, clean: Column) -> Column:
    """DT: a clean ``yyyy-MM-dd`` text, unparseable text, a null, a bad day."""
    return (F.when(key % 11 == 0, _s("not-a-date"))
            .when(key % 13 == 0, _s(None))
            .when(key % 17 == 0, _s("2024-13-45"))
            .otherwise(clean.cast("date").cast("string")))


def dirty_bigint(key: Column) -> Column:
    """BI: junk, a null, fractions, an exponent, forms that only some parsers
    take for numbers, a number just beyond BIGINT and the last one within, and ids
    above the INT range."""
    return (F.when(key % 10 == 0, _s("x1"))
            .when(key % 10 == 1, _s(None))
            .when(key % 10 == 2, F.concat(key.cast("string"), F.lit(".7")))
            .when(key % 10 == 3, F.concat(key.cast("string"), F.lit(".0")))
            .when(key % 70 == 4, _s("12d"))
            .when(key % 70 == 14, _s("77F"))
            .when(key % 70 == 24, _s("1e3"))
            .when(key % 70 == 34, _s("0x1p3"))
            .when(key % 70 == 44, _s("9223372036854775808"))
            .when(key % 70 == 54, _s("9223372036854775807.99999999999"))
            .otherwise((key + F.lit(3000000000)).cast("string")))


def dirty_null_token(key: Column, value: Column) -> Column:
    """NT: reader null tokens, a lower-case look-alike, blank and empty."""
    return key_case(key, 6, {0: "None", 1: "NA", 2: "none", 3: "  ", 4: ""}, value)


def dirty_list(key: Column, a: Column, b: Column) -> Column:
    """LS: list-strings — empty, null, junk, padded items, trailing comma,
    mixed quotes."""
    q, dq = F.lit("'"), F.lit('"')
    return key_case(key, 9, {
        0: "[]", 1: None, 2: "oops",
        3: F.concat(F.lit("["), q, a, q, F.lit(", "), q, a, F.lit(" "), q, F.lit("]")),
        4: F.concat(F.lit("["), q, b, q, F.lit(",]")),
    }, F.concat(F.lit("["), dq, a, dq, F.lit(", "), q, b, q, F.lit("]")))


def mismatch_pair(key: Column, value: Column) -> tuple[Column, Column]:
    """MM: two columns with nulls on either side and some differences."""
    a = F.when(key % 5 == 0, _s(None)).otherwise(value)
    b = (F.when(key % 3 == 0, _s(None)).when(key % 4 == 0, _s("Z"))
         .otherwise(value))
    return a, b
