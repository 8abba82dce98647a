"""Mixing sources to target weights, in DataFrame operations only.

Efraimidis-Spirakis sampling: a document with quality weight w gets the key
x = -ln(u) / w for a u that its id and text fix; small keys come first. Every
source first takes complete epochs of all its documents, then documents in key
order while the prefix sum of their words stays nearest to what is left of the
source's budget.

Prefix sums don't sort a source: the logarithm of the key cuts the keys into
ordered buckets, each 2^-18 of a doubling wide, so none holds more than about a
millionth of a source whatever its weights are. Sums of coarse buckets (4,096 fine
ones each) find the one where the budget ends, sums of its fine buckets the next,
and only the documents of that one are ordered. What leaves this is one cut key per source, so the documents are
compared with their source's row and neither sorted nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import free_name, written

WORD = r"[^\x20\x09-\x0D]+"
MOST_EPOCHS = 3
SEED = "mix-1"
#: a key is at least 2^-_LOW; a doubling of it has 2^_BITS buckets
_LOW, _BITS, _FINE = 60, 18, 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 less the signs #*$%&|<> per word, 0.1 at least."""
    signs = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0))
    return F.greatest(F.lit(0.1), F.lit(1.0) - signs.cast("double") / F.greatest(size, F.lit(1)).cast("double"))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: str = SEED) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def _bucket(x: Column) -> Column:
    return F.floor((F.log2(F.greatest(x, F.lit(2.0**-_LOW))) + F.lit(float(_LOW))) * F.lit(float(1 << _BITS))).cast("long")


def targets(sizes: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``, ``epochs`` and ``rest``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the sum
    of all sizes; no target exceeds ``most`` times its source, the excess goes to
    the others by weight until none does. With sources ordered by size / weight the
    capped ones come first, so one pass finds the final level.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("w", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    ranked = ranked.withColumn("cap", (most * F.col("source_size")).cast("double"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = ranked.withColumns({
        "rank": F.row_number().over(fill),
        "level": (F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
    }).withColumn("capped", F.col("cap") / F.col("w") <= F.col("level"))
    final = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.col("rank"))).over(whole)
    first_free = F.min(F.when(~F.col("capped"), F.col("rank"))).over(whole)
    target = F.when(first_free.isNull() | (F.col("rank") < first_free), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * final))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return level.withColumn("target", target).withColumn("epochs", F.least(epochs, F.lit(most).cast("long"))).select(
        "source", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"))


def cuts(keyed: DataFrame, budget: DataFrame) -> DataFrame:
    """``budget`` with ``edge`` (bucket where the rest ends) and ``cut`` (largest key
    taken there, null if none). ``keyed`` has source, size, x and b."""
    def edge_of(sums: DataFrame, by: str) -> DataFrame:
        w = Window.partitionBy("source").orderBy(by)
        ended = sums.withColumn("ends", F.sum("words").over(w) + F.col("begun")).withColumn("starts", F.col("ends") - F.col("words"))
        return ended.where("starts <= rest and ends > rest")

    coarse = F.shiftright("b", _FINE)
    one = keyed.groupBy("source", coarse.alias("c")).agg(F.sum("size").alias("words"))
    one = edge_of(one.join(budget.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("begun", F.lit(0)), "c")
    one = one.select(F.col("source").alias("s"), F.col("c").alias("edge"), F.col("starts").alias("begun"), "rest")
    two = keyed.join(one, F.col("source").eqNullSafe(F.col("s")) & (coarse == F.col("edge")))
    two = edge_of(two.groupBy("source", "b", "begun", "rest").agg(F.sum("size").alias("words")), "b")
    two = written(two.select(F.col("source").alias("s"), F.col("b").alias("edge"), F.col("starts").alias("begun"), "rest"), "edges")
    # rows of one key (repeated rows) are taken together
    three = keyed.join(two, F.col("source").eqNullSafe(F.col("s")) & (F.col("b") == F.col("edge")))
    three = three.groupBy("source", "x", "begun", "rest").agg(F.sum("size").alias("words"))
    ends = F.sum("words").over(Window.partitionBy("source").orderBy("x")) + F.col("begun")
    last = three.withColumn("ends", ends).where("rest > 0 and 2 * ends - words <= 2 * rest").groupBy(F.col("source").alias("s3")).agg(F.max("x").alias("cut"))
    out = budget.join(two.select("s", "edge"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return out.join(last, F.col("source").eqNullSafe(F.col("s3")), "left").drop("s3")


def _keyed(docs: DataFrame, doc_id: str, text: str, source: str, names: list[str]) -> DataFrame:
    size, weight, x, b = names
    return (
        docs.withColumn(size, n_words(docs[text]))
        .withColumn(weight, quality_weight(F.col(text), F.col(size)))
        .withColumn(x, sampling_key(F.col(doc_id), F.col(text), F.col(weight)))
        .withColumn(b, _bucket(F.col(x)))
    )


def _plan(narrow: DataFrame) -> DataFrame:
    budget = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")))
    return written(cuts(narrow, written(budget, "budgets")), "mix-plan")


def _copies(x: Column, b: Column, named: dict | None = None) -> Column:
    """How often a row is taken, from its key and its source's row of the plan."""
    p = {c: F.col((named or {}).get(c, c)) for c in ("rest", "edge", "cut", "epochs")}
    more = (p["rest"] > 0) & F.coalesce((b < p["edge"]) | ((b == p["edge"]) & (x <= p["cut"])), F.lit(False))
    return p["epochs"] + more.cast("long")


def _narrow(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    names = free_name(docs, "size", "weight", "x", "b")
    keyed = _keyed(docs, doc_id, text, source, names)
    return written(keyed.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                *[F.col(n).alias(a) for n, a in zip(names, ("size", "weight", "x", "b"))]), "mix-keys")


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: a row per row of docs.

    A null text has no words and is taken 0 words; null sources are one source,
    ordered last; rows that repeat id and text share a key and are taken alike;
    an empty table gives an empty result; other columns aren't read.
    """
    narrow = _narrow(docs, doc_id, text, source)
    plan = _plan(narrow).withColumnRenamed("source", "s")
    out = narrow.join(plan, F.col("source").eqNullSafe(F.col("s")))
    return out.select(F.col("doc_id").alias(doc_id), F.col("source"), "size", "source_size", "target",
                      _copies(F.col("x"), F.col("b")).alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed rows of ``docs``, each as often as it is taken, columns as they
    were. Texts are not shuffled: each row meets its source's row of the plan. Null
    texts have no words and are taken or left like other empty ones, null sources are one
    source, rows that repeat id and text are taken alike, and no rows give none."""
    names = free_name(docs, "mix_size", "mix_weight", "mix_x", "mix_b")
    keyed = _keyed(docs, doc_id, text, source, names)
    plan = _plan(_narrow(docs, doc_id, text, source))
    mine = free_name(docs, *[f"plan_{c}" for c in plan.columns])
    own = dict(zip(plan.columns, mine))
    joined = keyed.join(plan.toDF(*mine), F.col(f"`{source}`").eqNullSafe(F.col(own["source"])))
    times = _copies(F.col(names[2]), F.col(names[3]), own)
    copy = free_name(docs, "mix_copy")[0]
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
