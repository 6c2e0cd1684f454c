"""URL filter: rules first, then naive Bayes over segmented host and path words.

Method
------
Host names are often words written together.  Each run of letters of a host
or path is split by Viterbi under a unigram model of words: the split of
greatest probability, where a word's probability comes from its count in the
pages' own text and in a fixed list of web words, and a run that is no known
word costs a fixed sum for each character.  The words (those of the host and
those of the path are apart) are the features of a multinomial naive Bayes
model with classes allow and block.  It is fitted on fixed labelled names,
then once more with the hosts of all pages, each counted by its own
probability of either class (one step of expectation maximisation; in each
class the pages together weigh as much as the labelled names).

A url that a rule fits gets the rule's verdict; the longest rule wins.

Scale: all counts are kept in Spark tables, whatever their number: words of the
pages' text, and the expected counts of either class.  Distinct runs of letters
are cut into their substrings, which meet the word counts in a join; grouped by
run, a task splits each run with the counts it needs and no others.  Likewise
the words of distinct names meet the class counts in a join and add up their log
odds.  So no table of words is collected or held by a task; a small one (by its
counted rows) is sent to the tasks instead of shuffling the other side.  Judging
joins the pages with the scores of their names.

Defined results
---------------
* null url, or one without ``://``: empty host and path, no rule, and the
  verdict of an empty name;
* null ids and repeated rows: every row is judged on its own;
* ties: equal splits prefer the longer last word; rules of one length are
  told apart by their order;
* a very long run is split whole; words as long as any known one are looked for;
* an empty table gives no rows; other columns are ignored; a null html adds
  no words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, ids_side, python_tasks

#: Splits that a local segmenter remembers.
_MEMORY = 50_000
#: What the pages' expected words weigh against the labelled names, in each class.
EM_WEIGHT = 1.0
_RUN = re.compile(r"[a-z]+|[0-9]+")

# Names whose verdict is known, as words.
BLOCKED = (
    "casino bonus,free casino,online casino,casino slots,poker room,poker win,"
    "sports bets,bets online,betting tips,lotto win,jackpot slots,pills online,buy pills,"
    "cheap meds,meds online,viagra cheap,pharmacy cheap,adult cams,adult video,xxx video,"
    "porn tube,sex cams,live sex,nude pics,link farm,content farm,spam mail,"
    "ad server,ads server,click track,track pixel,pop ads,banner ads,malware drop,phish login,"
    "warez zone,crack serials,free money,cash loans,payday loans,quick loans,replica watches,"
    "cheap replica,weight loss pills,miracle cure,hot singles,dating hot").split(",")
ALLOWED = (
    "city news,daily news,news post,world news,art museum,national museum,public library,library books,"
    "history books,school math,open university,university press,science lab,research lab,research notes,"
    "garden club,book club,travel guide,city guide,food recipes,home recipes,music school,film review,"
    "book review,game review,code notes,open source,code docs,docs home,learn math,learn code,"
    "health clinic,family doctor,green energy,solar home,local weather,weather report,sports club,"
    "football league,town council,county office,data portal,map service,photo album,family album,"
    "travel notes,tech guide,word list,language school,bird watch").split(",")
#: Pseudo-counts of the words above in the unigram model.
LISTED = 20


def host_of(url: Column) -> Column:
    """Lower-cased host; empty for null or a url without ``://``."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of a few rules (verdict, host, path);
    null where none fits."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


@dataclass
class Segmenter:
    """Unigram Viterbi; counts of words, and their sum."""

    counts: dict[str, int]
    total: int = 0
    longest: int = 0
    memory: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        self.total = self.total or sum(self.counts.values()) or 1
        self.longest = max(map(len, self.counts), default=1)

    def split(self, run: str) -> list[str]:
        got = self.memory.get(run)
        if got is None:
            got = self._split(run)
            if len(self.memory) < _MEMORY:
                self.memory[run] = got
        return got

    def _split(self, run: str) -> list[str]:
        # an unknown word of n characters: as rare as one in total * 10 * 3^n
        unknown, each = math.log(self.total + 1) + math.log(10), math.log(3)
        best = [0.0] + [math.inf] * len(run)
        cut = [0] * (len(run) + 1)
        # the start from which an unknown word to the place at hand is cheapest
        far, base = 0, 0.0
        for end in range(1, len(run) + 1):
            if best[end - 1] - each * (end - 1) < base:
                far, base = end - 1, best[end - 1] - each * (end - 1)
            best[end], cut[end] = base + unknown + each * end, far
            for start in range(max(0, end - self.longest), end):
                n = self.counts.get(run[start:end])
                if n and best[start] + math.log(self.total / n) < best[end]:
                    best[end], cut[end] = best[start] + math.log(self.total / n), start
        out, end = [], len(run)
        while end:
            out.append(run[cut[end]:end])
            end = cut[end]
        return out[::-1]

    def words(self, host: str, path: str) -> list[str]:
        """Words of a host (its last label, the public part, as one) and path."""
        labels = host.split(".")
        out = [f"top:{labels[-1]}"] if len(labels) > 1 else []
        for label in labels[:-1] if len(labels) > 1 else labels:
            for r in _RUN.findall(label):
                out += [f"host:{w}" for w in (self.split(r) if r[0] > "9" else ["#"])]
        for r in _RUN.findall(path.lower()):
            out += [f"path:{w}" for w in (self.split(r) if r[0] > "9" else ["#"])]
        return out


@dataclass
class NaiveBayes:
    """Multinomial, with add-one smoothing; block against allow."""

    block: dict[str, float]
    allow: dict[str, float]
    prior: float = 0.0            # log odds of block
    size: int = 0                 # words, and one for all others
    totals: tuple[float, float] | None = None

    def __post_init__(self):
        self.size = self.size or len({*self.block, *self.allow}) + 1
        self.totals = self.totals or (sum(self.block.values()), sum(self.allow.values()))

    def log_odds(self, words: list[str]) -> float:
        """An unseen word says nothing."""
        out = self.prior
        for w in words:
            b, a = self.block.get(w, 0.0), self.allow.get(w, 0.0)
            if a or b:
                out += math.log((b + 1) / (self.totals[0] + self.size)) \
                    - math.log((a + 1) / (self.totals[1] + self.size))
        return out

    def block_probability(self, words: list[str]) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.log_odds(words)))))


@dataclass
class UrlModel:
    """The tables of the model: ``words`` (word, n) and ``classes`` (word, b,
    a), with their sums."""

    words: DataFrame
    total: int
    longest: int
    classes: DataFrame
    totals: tuple[float, float]
    size: int
    prior: float

    @property
    def segmenter(self) -> Segmenter:
        """For looking at single names by hand: draws the whole table."""
        return Segmenter({r["word"]: r["n"] for r in self.words.collect()})

    @property
    def bayes(self) -> NaiveBayes:
        """For looking at single names by hand: draws the whole table."""
        rows = self.classes.collect()
        return NaiveBayes({r["word"]: r["b"] for r in rows if r["b"]}, {r["word"]: r["a"] for r in rows if r["a"]},
                          self.prior, self.size, self.totals)


def listed_words() -> Counter:
    out: Counter = Counter()
    for name in (*BLOCKED, *ALLOWED):
        out.update({w: LISTED for w in name.split()})
    return out


def labelled_bayes() -> NaiveBayes:
    """From the fixed names alone; even classes, with a lean to allow."""
    counts = [Counter(f"host:{w}" for n in names for w in n.split()) for names in (BLOCKED, ALLOWED)]
    return NaiveBayes(dict(counts[0]), dict(counts[1]), math.log(0.3 / 0.7))


def text_words(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n): words of the pages' visible text."""
    text = F.regexp_replace(F.lower(F.col(html_col)), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    return (pages.select(F.explode(F.split(text, r"[^a-z]+")).alias("word"))
            .where(F.length("word") > 1).groupBy("word").agg(F.count("*").alias("n")))


def names_of(pages: DataFrame, url_col: str) -> DataFrame:
    """(host, path, n): distinct names; page numbers and other digits are one
    feature, so few paths are left."""
    url = F.col(f"`{url_col}`")
    return pages.select(host_of(url).alias("host"), _plain(path_of(url)).alias("path")) \
        .groupBy("host", "path").agg(F.count("*").alias("n"))


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "0")


def tokens_of(names: DataFrame) -> DataFrame:
    """(host, path, n, pos, kind, run): the runs of letters of each name in
    order, ``#`` for digits, and the host's last label as kind ``top``."""
    labels = F.split("host", r"\.")
    several = F.size(labels) > 1
    inner = F.when(several, F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0)))).otherwise(labels)
    runs = lambda text: F.regexp_extract_all(text, F.lit("([a-z]+|[0-9]+)"), F.lit(1))

    def token(kind: str):
        return lambda r: F.struct(F.lit(kind).alias("kind"), F.when(r.rlike("^[0-9]"), "#").otherwise(r).alias("run"))
    top = F.when(several, F.array(F.struct(F.lit("top").alias("kind"), F.element_at(labels, -1).alias("run")))) \
        .otherwise(F.array().cast("array<struct<kind:string,run:string>>"))
    every = F.concat(top, F.transform(F.flatten(F.transform(inner, runs)), token("host")),
                     F.transform(runs(F.lower("path")), token("path")))
    return names.select("host", "path", "n", F.posexplode(every).alias("pos", "t")) \
        .select("host", "path", "n", "pos", "t.kind", "t.run")


def splits_of(tokens: DataFrame, words: DataFrame, total: int, longest: int) -> DataFrame:
    """(run, parts): each distinct run of letters as words, with the counts of
    just the words that it holds."""
    python_tasks(tokens.sparkSession)
    runs = cut(tokens.where("kind <> 'top' and run <> '#'").select("run").distinct())

    def substrings(batches):
        for b in batches:
            for run in b.column(0).to_pylist():
                for start in range(0, len(run), 256):        # of a long run, a part at a time
                    found = list({run[i:j] for i in range(start, min(len(run), start + 256))
                                  for j in range(i + 1, min(len(run), i + longest) + 1)})
                    yield pa.RecordBatch.from_arrays([pa.array([run] * len(found)), pa.array(found)],
                                                     names=["run", "word"])

    def split(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for run, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            out.append(Segmenter({k["word"]: k["n"] for k in known or []}, total).split(run))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))],
                                          names=["run", "parts"])
    held = runs.mapInArrow(substrings, "run string, word string").join(ids_side(words), "word") \
        .groupBy("run").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    both = runs.join(held, "run", "left")
    return cut(both.mapInArrow(lambda batches: (split(b) for b in batches), "run string, parts array<string>"))


def words_of(names: DataFrame, words: DataFrame, total: int, longest: int) -> DataFrame:
    """(host, path, n, found): the words of each name in order (features)."""
    tokens = cut(tokens_of(names))
    parts = splits_of(tokens, words, total, longest)
    met = tokens.join(ids_side(parts), "run", "left")
    one = F.when(F.col("kind") == "top", F.array(F.concat(F.lit("top:"), F.col("run")))).otherwise(F.transform(
        F.coalesce("parts", F.array(F.col("run"))), lambda w: F.concat(F.col("kind"), F.lit(":"), w)))
    listed = met.groupBy("host", "path", "n").agg(F.array_sort(F.collect_list(F.struct("pos", one.alias("w")))).alias("l"))
    found = listed.select("host", "path", "n", F.flatten(F.col("l.w")).alias("found"))
    return names.join(found.drop("n"), ["host", "path"], "left").select(
        "host", "path", "n", F.coalesce("found", F.array().cast("array<string>")).alias("found"))


def fit(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> UrlModel:
    spark = pages.sparkSession
    python_tasks(spark)
    listed = spark.createDataFrame(list(listed_words().items()), "word string, n bigint")
    words = cut(text_words(pages, html_col).unionByName(listed).groupBy("word").agg(F.sum("n").alias("n")))
    sums = words.agg(F.sum("n").alias("n"), F.max(F.length("word")).alias("longest")).first()
    first = labelled_bayes()

    @F.pandas_udf("double")
    def probability(found: pd.Series) -> pd.Series:
        return pd.Series([first.block_probability(list(w)) for w in found], dtype="float64")

    names = words_of(cut(names_of(pages, url_col).where("host <> ''")), words, sums["n"], sums["longest"])
    # many pages of one host say little more than one
    soft = names.select(F.explode("found").alias("word"), probability("found").alias("p"), F.log1p("n").alias("n")) \
        .groupBy("word").agg(F.sum(F.round(F.col("p") * F.col("n"), 9).cast("decimal(28,9)")).alias("b"),
                             F.sum(F.round((1 - F.col("p")) * F.col("n"), 9).cast("decimal(28,9)")).alias("a"))
    soft = cut(soft.select("word", F.col("b").cast("double").alias("b"), F.col("a").cast("double").alias("a")))
    whole = soft.agg(F.sum(F.col("b").cast("decimal(38,9)")).alias("b"),
                     F.sum(F.col("a").cast("decimal(38,9)")).alias("a")).first()
    # each class gets its own share, so that words which all pages have alike
    # (the public part, languages, page numbers) speak for neither
    share = [EM_WEIGHT * t / float(whole[c] or 1) for t, c in zip(first.totals, "ba")]
    fixed = spark.createDataFrame([(w, float(first.block.get(w, 0)), float(first.allow.get(w, 0)))
                                   for w in sorted({*first.block, *first.allow})], "word string, b double, a double")
    classes = cut(soft.select("word", (F.col("b") * share[0]).alias("b"), (F.col("a") * share[1]).alias("a"))
                  .unionByName(fixed).groupBy("word").agg(F.sum("b").alias("b"), F.sum("a").alias("a")))
    size = classes.count() + 1
    totals = tuple(t * (1 + (EM_WEIGHT if whole[c] else 0)) for t, c in zip(first.totals, "ba"))
    return UrlModel(words, sums["n"], sums["longest"], classes, totals, size, first.prior)


def scores_of(names: DataFrame, model: UrlModel) -> DataFrame:
    """(host, path, score, words) of distinct names."""
    found = cut(words_of(names, model.words, model.total, model.longest))
    each = found.select("host", "path", F.explode("found").alias("word"))
    odds = F.log((F.col("b") + 1) / (model.totals[0] + model.size)) - F.log((F.col("a") + 1) / (model.totals[1] + model.size))
    seen = model.classes.where("b > 0 or a > 0").select("word", odds.alias("odds"))
    total = each.join(ids_side(cut(seen)), "word").groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    score = 1 / (1 + F.exp(-(F.coalesce("odds", F.lit(0.0)) + model.prior)))
    return found.join(total, ["host", "path"], "left").select(
        "host", "path", score.alias("score"), F.array_join("found", " ").alias("words"))


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = (),
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict, score, words): score is the model's
    probability of block, words the segmented words it rests on."""
    python_tasks(pages.sparkSession)
    names = cut(names_of(pages, url_col))
    scores = ids_side(cut(scores_of(names, model).withColumnRenamed("path", "plain")))
    src = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(F.col(f"`{url_col}`")).alias("host"),
                       path_of(F.col(f"`{url_col}`")).alias("path"))
    out = src.withColumn("plain", _plain(F.col("path"))).join(scores, ["host", "plain"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return out.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
                      F.coalesce(verdict, method).alias("verdict"), "score", "words")
