"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Starting from the tokens that are there, cell weights (uses per token)
are raked in turn to the language, topic and source marginals, within the repeat limits; the source marginals come last and hold. A document is
used the whole part of its cell's weight, and once more with the fraction as its probability: by sequential Poisson sampling, whose threshold per
source is calibrated so that the tokens drawn are those wanted.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, ship

#: Vocabulary file of a public tokenizer, where the session's ``spark.tessera.vocabulary`` names no other.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Classes that long words are hashed to. A document's "topic" is the class most of them fall in (0 without such words): it parts texts by their vocabulary, and
#: is no subject; a table with subjects of its own brings them as that column.
TOPICS = 16
_LONG = re.compile(r"[^\W\d_]{7,}")
#: Steps of the calibrated threshold: of r / (1 + r), where r is the ratio of a document's random number to its probability, so that no ratio is out of reach.
BINS = 8192
ROUNDS = 200


def one_spelling(source: Column) -> Column:
    """A source name without blanks around it, in lower case, its words joined by underscores; blank gives null."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(source, r"^[\s ]+|[\s ]+$", "")), r"[\s \-_]+", "_"), F.lit(""))


def language(lang: Column) -> Column:
    """The primary language tag in lower case; blank or null is ``und``."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(lang, r"^\s*([A-Za-z]{2,3})(?:[-_ ]|$)", 1)), F.lit("")), F.lit("und"))


class _Encoder:
    """The public tokenizer, built once in a process."""

    made: dict[int, object] = {}

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def tokens(self, texts: list[str]) -> list[int]:
        return [len(t) for k in range(0, len(texts), 256) for t in self.encoding.encode_ordinary_batch(texts[k : k + 256], num_threads=1)]


@lru_cache(maxsize=1 << 17)
def _class(word: str) -> int:
    h = 0
    for c in word:
        h = (h * 31 + ord(c)) & 0xFFFFFFFF
    return (h * 0x9E3779B1 & 0xFFFFFFFF) >> 28


def _topic(text: str) -> int:
    held = [0] * TOPICS
    for word, n in Counter(_LONG.findall(text.lower())).items():
        held[_class(word)] += n
    return held.index(max(held))


def _measure(vocabulary):
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = id(vocabulary)
        if key not in _Encoder.made:
            _Encoder.made = {key: _Encoder(vocabulary.value)}
        encoder = _Encoder.made[key]
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("source"), batch.column("lang"), pa.array([_topic(t) for t in texts], pa.int32()), pa.array(encoder.tokens(texts), pa.int64())], names=["id", "source", "lang", "topic", "tokens"]
            )

    return measure


def measured(docs: DataFrame, id_column: str, text: str, source: str, lang: str, vocabulary: str | None = None) -> DataFrame:
    """``id, source, lang, topic, tokens`` of every document: source in one spelling, size in tokens of the public tokenizer whose file is ``vocabulary``."""
    ship(docs.sparkSession)
    with open(vocabulary or docs.sparkSession.conf.get("spark.tessera.vocabulary", VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), one_spelling(F.col(source)).alias("source"), language(F.col(lang)).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(_measure(docs.sparkSession.sparkContext.broadcast(ranks)), f"id {kind}, source string, lang string, topic int, tokens long")


def rake(tokens: np.ndarray, source: np.ndarray, wanted: np.ndarray, limits: np.ndarray, others: list[np.ndarray], rounds: int = ROUNDS, start: np.ndarray | None = None) -> np.ndarray:
    """Uses per token of each cell: the sums by source come to ``wanted`` or, where that is more than there is, to its limit;
    the marginals of ``others`` come as near to those of the cells taken together as limits and sources allow.

    tokens: of each cell; source: number of each cell's source; wanted, limits: by source; others: a numbering of the cells per further marginal; start: weights to begin with (1).
    """
    there = np.bincount(source, tokens, len(wanted))
    goal = np.minimum(wanted, there * limits)
    if not len(tokens):
        return np.zeros(0)
    weight = np.ones(len(tokens)) if start is None else start
    share = [np.bincount(o, tokens) / max(tokens.sum(), 1) for o in others]
    for _ in range(rounds):
        before = weight.copy()
        for o, s in zip(others, share, strict=True):
            now = np.bincount(o, tokens * weight)
            factor = np.divide(s * goal.sum(), now, out=np.ones_like(now), where=now > 0)
            weight = np.minimum(weight * factor[o], limits[source])
        for _ in range(20):  # cells at their limit leave what they can't take to the source's other cells
            now = np.bincount(source, tokens * weight, len(wanted))
            free = weight < limits[source] * (1 - 1e-12)
            loose = np.bincount(source[free], (tokens * weight)[free], len(wanted))
            factor = np.divide(goal - (now - loose), loose, out=np.ones_like(now), where=loose > 0)
            weight = np.where(free, np.minimum(weight * np.maximum(factor, 0)[source], limits[source]), weight)
            if np.all(np.abs(np.bincount(source, tokens * weight, len(wanted)) - goal) <= 1e-9 * np.maximum(goal, 1)):
                break
        if np.abs(weight - before).max(initial=0) < 1e-10:
            break
    return weight


def mixtures(docs: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Draws ``run_name, id, source, tokens, uses``, the report of every run's sources, and that of its languages and topics.

    docs: as from ``measured`` (read several times: best a written table). targets: ``run_name, source, target_share, max_repeats,
    size_factor``. The wanted size of a run is ``size_factor`` times the tokens of all documents, a source's part its share of that. Report:
    ``run_name, source, target_share, wanted_tokens, available_tokens`` (with all repeats)``, drawn_tokens, actual_share`` (of all drawn in the
    run)``, shortfall_tokens, documents, uses``. A source without documents is reported with nothing drawn; documents of null or other
    sources are not drawn but count in the wanted size; documents of no tokens are not drawn; an empty table of documents gives zeros.
    The second report: ``run_name, marginal`` (``lang`` or ``topic``)``, value, wanted_share`` (of the run's sources taken together)``, raked_share`` (what limits and sources
    allow, after ROUNDS rounds at most)``, drawn_share, moved`` (the largest change of a weight in the last round: 0 when the raking has settled).
    """
    spark = docs.sparkSession
    goals = targets.select("run_name", one_spelling(F.col("source")).alias("source"), "target_share", "max_repeats", "size_factor")
    cells = docs.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    whole = int(docs.agg(F.sum("tokens")).first()[0] or 0)
    runs: dict[str, list] = {}
    for r in goals.orderBy("run_name", "source").collect():
        runs.setdefault(r["run_name"], []).append(r)
    # bounded: sources of the targets, times two- or three-letter languages, times TOPICS
    held = [r for r in cells.join(F.broadcast(goals.select("source").distinct()), "source").where("tokens > 0").collect()]
    weights, wants, sides = [], [], []
    for run, of in runs.items():
        names = [r["source"] for r in of]
        own = [c for c in held if c["source"] in set(names)]
        source = np.array([names.index(c["source"]) for c in own], np.int64)
        tokens = np.array([c["tokens"] for c in own], float)
        wanted = np.array([r["target_share"] * r["size_factor"] * whole for r in of])
        limits = np.array([float(r["max_repeats"]) for r in of])
        number = lambda column: np.unique([str(c[column]) for c in own], return_inverse=True)[1] if own else np.zeros(0, np.int64)  # noqa: B023, E731
        others = [number("lang"), number("topic")]
        weight = rake(tokens, source, wanted, limits, others)
        moved = float(np.abs(rake(tokens, source, wanted, limits, others, 1, weight) - weight).max(initial=0))
        for side in ("lang", "topic"):
            for value in sorted({str(c[side]) for c in own}):
                held_by = np.array([str(c[side]) == value for c in own])
                sides.append((run, side, value, float(tokens[held_by].sum() / tokens.sum()), float((tokens * weight)[held_by].sum() / max((tokens * weight).sum(), 1e-9)), moved))
        weights += [(run, c["source"], c["lang"], c["topic"], float(w)) for c, w in zip(own, weight, strict=True)]
        there = np.bincount(source, tokens, len(names)) if len(own) else np.zeros(len(names))
        for r, want, limit, t in zip(of, wanted, limits, there, strict=True):
            wants.append((run, r["source"], float(r["target_share"]), int(round(want)), int(t * limit), float(min(want, t * limit)), int(limit)))
    wanted_frame = spark.createDataFrame(wants, "run_name string, source string, target_share double, wanted_tokens long, available_tokens long, goal double, max_repeats int")
    weight_frame = spark.createDataFrame(weights, "run_name string, source string, lang string, topic int, weight double")
    # a hair below a whole number of uses is that number
    whole_uses = F.floor(F.col("weight") + 1e-9).cast("int")
    drawn = docs.where("tokens > 0").join(F.broadcast(weight_frame), ["source", "lang", "topic"])
    random = (F.pmod(F.xxhash64("id", "run_name", F.lit("draw")), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    chance = F.greatest(F.col("weight") - F.col("base"), F.lit(0.0))
    ranked = drawn.select("run_name", "id", "source", "lang", "topic", "tokens", "weight", whole_uses.alias("base")).withColumn("chance", chance)
    step = F.when(F.col("chance") > 1e-9, F.least(F.floor(random / (random + F.col("chance")) * BINS), F.lit(BINS - 1))).otherwise(F.lit(BINS)).cast("int")
    ranked = ranked.withColumn("step", step)
    # tokens by step: at most BINS rows per run and source
    sums = ranked.groupBy("run_name", "source", "step").agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("base")).alias("sure")).collect()
    goal_of = {(w[0], w[1]): w[5] for w in wants}
    by: dict[tuple[str, str], np.ndarray] = {}
    sure: Counter = Counter()
    for r in sums:
        by.setdefault((r["run_name"], r["source"]), np.zeros(BINS + 1))[r["step"]] += r["t"]
        sure[r["run_name"], r["source"]] += r["sure"]
    limits_of = []
    for key, steps in by.items():
        total = np.cumsum(steps[:BINS]) + sure[key]
        k = int(np.searchsorted(total, goal_of[key]))  # the first step that reaches the goal
        below = total[k - 1] if k else sure[key]
        take = k if k < BINS and total[k] - goal_of[key] <= goal_of[key] - below else k - 1
        limits_of.append((*key, take))
    threshold = spark.createDataFrame(limits_of, "run_name string, source string, last int")
    draws = ranked.join(F.broadcast(threshold), ["run_name", "source"]).withColumn("uses", F.col("base") + (F.col("step") <= F.col("last")).cast("int") * (F.col("step") < BINS).cast("int"))
    full = cut(draws.where("uses > 0").select("run_name", "id", "source", "lang", "topic", "tokens", "uses"))
    draws = full.select("run_name", "id", "source", "tokens", "uses")
    got = draws.groupBy("run_name", "source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("drawn_tokens"), F.count("*").alias("documents"), F.sum("uses").alias("uses"))
    run_total = got.groupBy("run_name").agg(F.sum("drawn_tokens").alias("run_tokens"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    report = wanted_frame.join(got, ["run_name", "source"], "left").join(run_total, "run_name", "left")
    report = report.select(
        "run_name", "source", "target_share", "wanted_tokens", "available_tokens", none("drawn_tokens"), F.coalesce(F.round(F.col("drawn_tokens") / F.col("run_tokens"), 6), F.lit(0.0)).alias("actual_share"),
        F.greatest(F.col("wanted_tokens") - F.coalesce("drawn_tokens", F.lit(0)), F.lit(0)).alias("shortfall_tokens"), none("documents"), none("uses"),
    )
    side_frame = spark.createDataFrame(sides, "run_name string, marginal string, value string, wanted_share double, raked_share double, moved double")
    both = F.explode(F.array(*[F.struct(F.lit(c).alias("marginal"), F.col(c).cast("string").alias("value")) for c in ("lang", "topic")]))
    drawn_of = full.select("run_name", (F.col("tokens") * F.col("uses")).alias("t"), both.alias("m")).groupBy("run_name", "m.marginal", "m.value").agg(F.sum("t").alias("t"))
    marginals = side_frame.join(drawn_of, ["run_name", "marginal", "value"], "left").join(run_total, "run_name", "left")
    rounded = lambda c: F.round(F.col(c), 6).alias(c)
    drawn_share = F.coalesce(F.round(F.col("t") / F.col("run_tokens"), 6), F.lit(0.0)).alias("drawn_share")
    return draws, report, marginals.select("run_name", "marginal", "value", rounded("wanted_share"), rounded("raked_share"), drawn_share, "moved")
