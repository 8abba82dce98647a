"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose ratio lies above a cutoff. The candidate cutoffs
are a fixed grid from lenient to strict; which of them act is not set by hand: for
every stratum the strictest ones are taken at which labelled good documents prove
that few good ones are lost. Two ways are tried, each with half of the level ``delta``:

* All rules together: one path whose steps hold a cutoff of every rule. Null hypothesis
  of a step: its rules together reject a share ``risk`` of the good documents or more.
  The exact p-value is the binomial tail P(Bin(n, risk) <= k) for k of n good ones
  rejected (the one-sided Clopper-Pearson bound lies below ``risk`` iff p <= level),
  the level ``delta`` / (2 x strata). 99 good labels without a loss prove a step
  where there are 4 strata.
* Each rule by itself: the same for a share of ``risk`` / rules at the level
  ``delta`` / (2 x rules x strata), so a rule that good documents break doesn't stop the
  others where labels suffice (666 without a loss at 4 strata).

Along a path the steps are tested from lenient to strict and testing stops at the
first that isn't proven (fixed-sequence testing needs no further correction); rules
and strata are corrected for by Bonferroni. So with probability 1 - ``delta`` no
stratum loses more than ``risk`` of its good documents to all rules together. A
stratum takes that of the two proven sets of cutoffs that rejects more of its
documents; without enough labels it has none, and no rule rejects its documents.

Evidence is distinct texts, not rows: copies of one good document prove no more than
that document does.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.features import FEATURES, text_features
from tillroll.llm.scratch import free_name, written

#: rule -> (numerator, denominator, candidate cutoffs from lenient to strict)
RULES = {
    "symbols": ("n_symbols", "n_words", (1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "bangs": ("n_bangs", "n_words", (1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeat_words": ("n_repeat_words", "n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15)),
    "upper": ("n_upper", "word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
}
RISK = 0.05
DELTA = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratio(rule: str) -> Column:
    top, bottom, _ = RULES[rule]
    return F.col(top).cast("double") / F.greatest(F.col(bottom), F.lit(1)).cast("double")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact up to floating point."""
    return math.fsum(
        math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
        for i in range(k + 1)
    )


def proven_cutoffs(counts: list[dict], rules: dict, risk: float, delta: float) -> list[tuple]:
    """(stratum, rule, cutoff or None) from the good and lost counts of each stratum."""
    share, level = risk / len(rules), delta / (len(rules) * max(1, len(counts)))
    out = []
    for row in counts:
        for rule, (_, _, grid) in rules.items():
            found = None
            for i, cutoff in enumerate(grid):
                lost, n = row[f"{rule}_{i}"], row["n_good"]
                if lost > share * n or binomial_tail(lost, n, share) > level:
                    break
                found = cutoff
            out.append((row["stratum"], rule, found))
    return out


def joint_path(rules: dict) -> list[dict]:
    """Cutoffs of all rules together, from lenient to strict."""
    steps = max(len(grid) for _, _, grid in rules.values())
    return [{r: grid[i * len(grid) // steps] for r, (_, _, grid) in rules.items()} for i in range(steps)]


def proven_jointly(counts: list[dict], rules: dict, risk: float, delta: float) -> list[tuple]:
    """(stratum, rule, cutoff or None) of the strictest proven step of the joint path."""
    level = delta / max(1, len(counts))
    out = []
    for row in counts:
        found = dict.fromkeys(rules)
        for i, step in enumerate(joint_path(rules)):
            lost, n = row[f"joint_{i}"], row["n_good"]
            if lost > risk * n or binomial_tail(lost, n, risk) > level:
                break
            found = step
        out += [(row["stratum"], r, found[r]) for r in rules]
    return out


def good_counts(features: DataFrame, labels: DataFrame, doc_id: str, stratum: str, text_key: str, rules: dict) -> list[dict]:
    """Distinct good texts of every stratum, and how many each cutoff and each step of
    the joint path rejects.

    ``labels`` has ``doc_id`` and ``quality`` (1: good). Rows with a null in either
    are no evidence; a text that is labelled more than once is good only if all its
    labels say so. Only texts that pass the base rules are evidence, as the rules
    decide on those alone. A null stratum is a stratum of its own. The stratum is a
    column of few values (languages): its counts come to the driver, documents don't.
    """
    labelled = (
        labels.where(labels["quality"].isNotNull() & labels[doc_id].isNotNull())
        .groupBy(labels[doc_id].alias("_label_id")).agg(F.min("quality").alias("_q"))
    )
    rejected = {f"{r}_{i}": ratio(r) > c for r, (_, _, grid) in rules.items() for i, c in enumerate(grid)}
    rejected |= {f"joint_{i}": reduce(or_, [ratio(r) > c for r, c in step.items()]) for i, step in enumerate(joint_path(rules))}
    strata = [r[0] for r in features.select(stratum).distinct().collect()]
    evidence = features.where(~base_failed()).join(labelled, features[doc_id] == labelled["_label_id"])
    # equal texts have equal counts, so any row of a text speaks for it
    texts = evidence.groupBy(F.col(stratum).alias("_s"), F.col(text_key).alias("_t")).agg(
        F.min("_q").alias("_q"), *[F.max(hit).alias(name) for name, hit in rejected.items()]).where("_q = 1")
    lost = [F.count_if(F.col(name)).alias(name) for name in rejected]
    seen = {r["_s"]: r.asDict() for r in texts.groupBy("_s").agg(F.count("*").alias("n_good"), *lost).collect()}
    none = {"n_good": 0} | dict.fromkeys(rejected, 0)
    return [none | seen.get(s, {}) | {"stratum": s} for s in strata]


def learn_cutoffs(features: DataFrame, labels: DataFrame, doc_id: str, stratum: str, text_key: str,
                  rules: dict = RULES, risk: float = RISK, delta: float = DELTA) -> list[tuple]:
    """(stratum, rule, cutoff or None): of the cutoffs proven rule by rule and those
    proven jointly, in each stratum those that reject more documents."""
    counts = good_counts(features, labels, doc_id, stratum, text_key, rules)
    sets = [proven(counts, rules, risk, delta / 2) for proven in (proven_jointly, proven_cutoffs)]
    judged = [
        verdicts(features, cutoffs, stratum).where("not base_failed and not kept").groupBy(F.col(stratum).alias("_s")).agg(F.count("*").alias("n"))
        for cutoffs in sets
    ]
    jointly, apart = ({r["_s"]: r["n"] for r in part.collect()} for part in judged)
    return [a if apart.get(a[0], 0) > jointly.get(a[0], 0) else j for j, a in zip(*sets)]


def verdicts(features: DataFrame, cutoffs: list[tuple], stratum: str) -> DataFrame:
    """Add ``base_failed``, ``failed_rules`` (names, comma-joined) and ``kept``."""
    failed = []
    for rule in dict.fromkeys(r for _, r, _ in cutoffs):
        hit = F.lit(False)
        for s, r, cutoff in cutoffs:
            if r == rule and cutoff is not None:
                hit = hit | (F.col(stratum).eqNullSafe(F.lit(s)) & (ratio(rule) > cutoff))
        failed.append(F.when(hit, F.lit(rule)))
    return (
        features.withColumn("base_failed", base_failed())
        .withColumn("failed_rules", F.concat_ws(",", *failed) if failed else F.lit(""))
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
    )


def _counted(docs: DataFrame, columns: list[str], text: str) -> tuple[DataFrame, dict[str, str], str]:
    """Written counts of every text beside the columns, under names that can't clash:
    the table, the name of each column in it, and that of the text's digest."""
    key = free_name(docs, "text_digest")[0]
    keep = [*columns, key]
    table = written(text_features(docs.withColumn(key, F.md5(docs[text])), keep, text, named=False), "quality-features")
    names = {c: f"_k{i}" for i, c in enumerate(keep)}
    return table, names, names[key]


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", **options) -> DataFrame:
    """Features, verdict and failed rules of every document, a row per row of docs.

    The counts go once to a narrow table in the shared folder; the cutoffs and
    the verdicts both read that instead of the texts. Null text has no words, so
    the base rule fails it; an empty table gives an empty table; repeated rows are
    judged alike; extra columns of ``docs`` are ignored.
    """
    features, names, key = _counted(docs, [doc_id, stratum], text)
    renamed = labels.select(labels[doc_id].alias(names[doc_id]), labels["quality"])
    cutoffs = learn_cutoffs(features, renamed, names[doc_id], names[stratum], key, **options)
    judged = verdicts(features, cutoffs, names[stratum]).drop(key)
    return judged.withColumnsRenamed({v: c for c, v in names.items() if v != key})


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were (whatever their names);
    the verdicts are those of ``judge``.

    Texts are counted once and never shuffled: the rows are written with their counts,
    the cutoffs read the counts, and the rows are filtered in place. Null texts have
    no words and go; an empty table stays empty; repeated rows stay or go together.
    """
    table, names, key = _counted(docs, docs.columns, text)
    features = table.select(names[doc_id], names[stratum], key, *FEATURES)
    renamed = labels.select(labels[doc_id].alias(names[doc_id]), labels["quality"])
    cutoffs = learn_cutoffs(features, renamed, names[doc_id], names[stratum], key, **options)
    kept = verdicts(table, cutoffs, names[stratum]).where("kept")
    return kept.select(*[F.col(names[c]).alias(c) for c in docs.columns])
