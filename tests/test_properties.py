"""Property checks on seeded random inputs, with pandas / the Python
property runs one Spark job over a few thousand generated values."""

from __future__ import annotations

import ast
import random

import pandas as pd

from dq_mart.functions import bigint_or_zero, parse_list_string, yes_no
from dq_mart.functions.text import strip_ws
from dq_mart.operators.cleaning import dedup_keep_first

SEED = 20261203
WS = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\xa0", " "]


def _rand_text(rng: random.Random, alphabet: list[str], n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_yes_no_matches_python(spark):
    rng = random.Random(SEED)
    words = ["yes", "YES", "Yes", "no", "NO", "true", "True", "1", "0", "y", "on", "", "1.0"]
    vals = [_rand_text(rng, WS, rng.randint(0, 2)) + rng.choice(words)
            + _rand_text(rng, WS, rng.randint(0, 2)) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(yes_no("v")).collect()]
    want = [v.strip().lower() in ("yes", "true", "1") for v in vals]
    assert got == want


def test_strip_matches_python(spark):
    rng = random.Random(SEED + 1)
    vals = [_rand_text(rng, WS + ["a", "b", " "], rng.randint(0, 8)) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(strip_ws("v")).collect()]
    assert got == [v.strip() for v in vals]


def test_bigint_or_zero_matches_pandas(spark):
    rng = random.Random(SEED + 2)
    vals = []
    for _ in range(3000):
        kind = rng.randint(0, 4)
        if kind == 0:
            vals.append(str(rng.randint(-10**12, 10**12)))
        elif kind == 1:
            vals.append(f"{rng.randint(-10**6, 10**6)}.{rng.randint(0, 99)}")
        elif kind == 2:
            vals.append(_rand_text(rng, list("abcx-."), rng.randint(1, 4)))
        elif kind == 3:
            vals.append(" " + str(rng.randint(0, 999)) + " ")
        else:
            vals.append(None)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(bigint_or_zero("v")).collect()]
    want = pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce").fillna(0) \
        .astype("int64").tolist()
    assert got == want


def test_list_strings_match_literal_eval(spark):
    rng = random.Random(SEED + 3)
    items = ["BR01", "BR 2", "X", "O'x", "a,b", ""]
    vals = []
    for _ in range(2000):
        chosen = [rng.choice(items) for _ in range(rng.randint(0, 4))]
        q = rng.choice(["'", '"'])
        parts = []
        for it in chosen:
            if q == "'":
                parts.append("'" + it.replace("'", "\\'") + "'")
            else:
                parts.append('"' + it + '"')
        body = rng.choice([", ", ",", " , "]).join(parts)
        if chosen and rng.random() < 0.2:
            body += ","
        opener, closer = rng.choice([("[", "]"), ("[", "]"), ("(", ")")])
        if opener == "(" and len(chosen) == 1 and not body.endswith(","):
            body += ","          # a one-element tuple needs its comma
        vals.append(opener + body + closer)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(parse_list_string("v")).collect()]
    for raw, g in zip(vals, got):
        assert g == [str(x) for x in ast.literal_eval(raw)], raw


def test_keep_first_matches_pandas(spark):
    rng = random.Random(SEED + 4)
    # one key holds a third of the rows (the hot-key case)
    rows = [(("HOT" if rng.random() < 1 / 3 else f"K{rng.randint(0, 300)}")
             if rng.random() > 0.02 else None, i, rng.randint(0, 9)) for i in range(6000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ord int, v int")
    got = sorted((r.k or "", r.ord, r.v) for r in dedup_keep_first(df, ["k"], "ord").collect())
    pdf = pd.DataFrame(rows, columns=["k", "ord", "v"]).sort_values("ord")
    want = sorted((("" if pd.isna(k) else k), o, v) for k, o, v in
                  pdf.drop_duplicates(subset=["k"], keep="first").itertuples(index=False))
    assert got == want
