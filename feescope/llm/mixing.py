"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Targets.  Sources in code point order (null last) weigh 5, 2, 1, repeating, and
share the corpus size in words; no source's target exceeds ``max_epochs`` times
its size, and the excess is reshared by weight until none is above (computed in
one pass over the sources sorted by size per weight).

Selection.  A source's target is split into whole epochs, which take every
document, and a rest.  For the rest documents are ordered by an exponential key
``-ln(u) / quality`` (u: uniform, from a hash of doc_id) and taken while the
running sum of words stays within it.  Documents after the first that is too
long are tried in the same order (``fill_rounds`` times), then one more is
taken if that lands closer to the target.
Quality is that of a text's mean word length, against 6 letters or, with ``lang``,
against the usual one of its language, so that no language comes last for its long words.

Scale.  A source may hold any share of the rows, so its order is never sorted in
one task: keys are cut into sqrt(rows) / 8 buckets a unit of a scale, key / (1 + key)
up to a key of 1 and a unit every six doublings from there; the buckets' sums are
accumulated per source, and only the one bucket in which the target falls is
sorted.  Whatever the quality weights in (0, 1], the density of exponential keys on
that scale is at most 1.53, so a bucket holds about 12 sqrt(rows) rows at most;
large keys of low quality (texts of one long word) don't pile up at an end.
What is sorted in one task is one row per source, or per bucket of a source.

Defined cases: null text has size 0; a null doc_id is drawn by its text; null ``source`` is a source of its own;
rows that agree in doc_id, source and text are taken or left together;
documents without words are never counted (``taken`` 0) and the mix leaves them
out; an empty table gives an empty result; reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope.session import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
USUAL_WORD = 6.0  # letters
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_quality(letters: Column, size: Column, usual: Column | None = None) -> Column:
    """Quality weight of a text by its code points and words, in (0, 1]: 1 at a mean word length of ``usual`` (6)."""
    usual = F.lit(USUAL_WORD) if usual is None else usual
    mean = letters / F.greatest(size, F.lit(1))
    return F.lit(1.0) / (F.lit(1.0) + F.abs(F.coalesce(mean, F.lit(0.0)) - usual) / usual)


def text_quality(text: Column, size: Column, usual: Column | None = None) -> Column:
    """Default quality weight, in (0, 1]: 1 at a mean word length of ``usual`` (6), less the further from it."""
    return word_quality(F.length(text), size, usual)


def usual_word_lengths(texts: DataFrame, lang: str, letters: Column, size: Column) -> dict[str, float]:
    """Language -> median over its texts of their mean word length, in steps of a 16th of a doubling.

    Steps keep the aggregation at some hundred values a language; the driver receives one.
    """
    step = F.floor(F.log2(F.try_divide(letters, size)) * 16)  # null without words
    rows = texts.where(F.col(lang).isNotNull()).groupBy(lang).agg(F.median(step).alias("step")).collect()
    return {r[lang]: 2 ** ((r["step"] + 0.5) / 16) for r in rows if r["step"] is not None}


def _usual(lengths: dict[str, float], lang: str) -> Column:
    """The usual word length of the language in ``lang``, 6 where that is unknown."""
    if not lengths:
        return F.lit(USUAL_WORD)
    by_lang = F.create_map(*[F.lit(x) for pair in sorted(lengths.items()) for x in pair])
    return F.coalesce(F.try_element_at(by_lang, F.col(lang)), F.lit(USUAL_WORD))


def sampling_key(doc_id: Column, text: Column, quality: Column) -> Column:
    """Exponential key; smaller keys come first.  The hash is MD5 so that SQL engines agree on it."""
    drawn = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    digits = F.conv(F.substring(F.md5(drawn.cast("binary")), 1, 12), 16, 10)
    u = (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    return -F.log(u) / quality


def _prepared(docs: DataFrame, quality: Column | None) -> DataFrame:
    """docs with helper columns: size, key, hash of the text, source as a joinable pair."""
    size = F.col("__llm_size")
    return (docs.withColumn("__llm_size", word_count(F.col("text")))
            .withColumns({
                "__llm_key": sampling_key(F.col("doc_id"), F.col("text"), quality if quality is not None else text_quality(F.col("text"), size)),
                "__llm_hash": F.xxhash64("text"),
                "__llm_src": F.coalesce("source", F.lit("")),
                "__llm_nosrc": F.col("source").isNull(),
            }))


def _sizes(docs: DataFrame, quality: Column | None, lang: str | None) -> tuple[DataFrame, Column | None]:
    """(doc_id with the helper columns, written; the quality weight for :func:`_prepared_once`).

    With ``lang`` the texts are still read once: keys are written at quality 1 and divided by it when
    the usual word lengths are known.
    """
    own = ["doc_id", "__llm_size", "__llm_key", "__llm_hash", "__llm_src", "__llm_nosrc"]
    if lang is None:
        return materialize(_prepared(docs, quality).select(*own), "mix-sizes"), quality
    words = materialize(_prepared(docs, F.lit(1.0)).select(
        *own, F.length("text").alias("__llm_letters"), F.col(lang).alias("__llm_lang")), "mix-sizes")
    letters, size = F.col("__llm_letters"), F.col("__llm_size")
    lengths = usual_word_lengths(words, "__llm_lang", letters, size)
    key = F.col("__llm_key") / word_quality(letters, size, _usual(lengths, "__llm_lang"))
    return words.withColumn("__llm_key", key).select(*own), text_quality(F.col("text"), size, _usual(lengths, lang))


def _prepared_once(docs: DataFrame, quality: Column | None) -> DataFrame:
    """:func:`_prepared` for frames that carry whole texts.

    A generator computes the helper columns, because filters on its output stay
    above it: as plain expressions they would be copied into every filter and
    join condition on them, and the words of a text counted many times.
    """
    size = F.col("__llm_size")
    sized = docs.select("*", F.inline(F.array(F.struct(word_count(F.col("text")).alias("__llm_size")))))
    key = sampling_key(F.col("doc_id"), F.col("text"), quality if quality is not None else text_quality(F.col("text"), size))
    return sized.select("*", F.inline(F.array(F.struct(
        key.alias("__llm_key"), F.xxhash64("text").alias("__llm_hash"), F.coalesce("source", F.lit("")).alias("__llm_src"),
        F.col("source").isNull().alias("__llm_nosrc")))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", F.col("source_size").cast("double").alias("n"), weight.alias("w"))
    s = s.withColumns({"cap": F.lit(float(max_epochs)) * F.col("n"), "total": F.sum("n").over(everything),
                       "weights": F.sum("w").over(everything)})
    by_room = W.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    # the share per weight if this source and all with more room got no cap
    s = s.withColumn("share", (F.col("total") - (F.sum("cap").over(by_room) - F.col("cap")))
                     / (F.col("weights") - (F.sum("w").over(by_room) - F.col("w"))))
    s = s.withColumn("capped", F.col("cap") / F.col("w") < F.col("share"))
    level = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("w")).alias("r"), "share"))).over(everything)
    return s.select("source", F.col("n").cast("long").alias("source_size"),
                    F.when(F.col("capped"), F.col("cap")).otherwise(level["share"] * F.col("w")).alias("target"))


def _plan(base: DataFrame, weights, max_epochs: int, fill_rounds: int) -> tuple[DataFrame, DataFrame, float]:
    """(per source: target, epochs, bucket where the rest ends; decisions inside those buckets; buckets)."""
    source = ["__llm_src", "__llm_nosrc"]
    sums = materialize(base.groupBy(*source).agg(F.sum("__llm_size").alias("source_size"), F.count("*").alias("rows")),
                       "mix-sources")
    most = sums.agg(F.max("rows")).first()[0] or 1
    n_buckets = float(math.ceil(math.sqrt(most) / 8))  # some hundreds of rows or more to choose from in a bucket
    named = sums.select(F.when(~F.col("__llm_nosrc"), F.col("__llm_src")).alias("source"), "source_size")
    targets = source_targets(named, weights, max_epochs).select(
        F.coalesce("source", F.lit("")).alias("__llm_src"), F.col("source").isNull().alias("__llm_nosrc"),
        "source_size", "target")
    targets = targets.withColumn("__llm_epochs", F.when(F.col("source_size") > 0,
                                                       F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    targets = targets.withColumn("rest", F.col("target") - F.col("__llm_epochs") * F.col("source_size"))

    base = base.withColumn("__llm_bucket", bucket(n_buckets))
    upto = W.partitionBy(*source).orderBy("__llm_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = base.groupBy(*source, "__llm_bucket").agg(F.sum("__llm_size").alias("n")).withColumn("upto", F.sum("n").over(upto))
    ends = parts.join(targets, source).where(F.col("upto") > F.col("rest")).groupBy(*source).agg(
        F.min(F.struct("__llm_bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("e"))
    plan = targets.join(ends, source, "left").select(
        *source, "source_size", "target", "__llm_epochs", "rest",
        F.coalesce("e.__llm_bucket", F.lit(-1).cast("long")).alias("__llm_end"),
        F.coalesce("e.before", F.lit(0)).alias("before"))
    plan = materialize(plan, "mix-plan")

    # the buckets in which the rests end: one row per group of equal rows, taken by running sums
    rows = base.join(plan, source).where(F.col("__llm_bucket") == F.col("__llm_end"))
    rows = rows.groupBy(*source, "__llm_key", "doc_id", "__llm_hash").agg(
        F.sum("__llm_size").alias("n"), F.first(F.col("rest") - F.col("before")).alias("gap")).withColumn("flag", F.lit(0))
    whole = W.partitionBy(*source)
    order = whole.orderBy("__llm_key", "doc_id", "__llm_hash")
    for _ in range(1 + fill_rounds):
        fits = (F.col("flag") == 0) & (F.col("n") <= F.col("gap")) if _ else F.col("flag") == 0
        rows = rows.withColumn("run", F.sum(F.when(fits, F.col("n")).otherwise(F.lit(0))).over(
            order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        rows = rows.withColumn("now", (fits & (F.col("run") <= F.col("gap"))).cast("int"))
        rows = rows.withColumn("gap", F.col("gap") - F.sum(F.col("now") * F.col("n")).over(whole)).withColumn(
            "flag", F.col("flag") + F.col("now"))
    nearer = F.when((F.col("flag") == 0) & (F.col("n") > 0) & (F.abs(F.col("gap") - F.col("n")) < F.col("gap")),
                    F.struct(F.abs(F.col("gap") - F.col("n")).alias("d"), "__llm_key", "doc_id", "__llm_hash"))
    rows = rows.withColumn("one", F.min(nearer).over(whole))
    last = (F.col("flag") == 0) & F.col("one").isNotNull() & (F.col("one.__llm_key") == F.col("__llm_key")) & (
        F.col("one.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("one.__llm_hash") == F.col("__llm_hash"))
    decided = rows.select(*source, F.coalesce("doc_id", F.lit(0).cast("long")).alias("__llm_id"),
                          F.col("doc_id").isNull().alias("__llm_noid"), "__llm_hash",
                          (F.col("flag") + last.cast("int")).alias("__llm_flag"))
    return plan, materialize(decided, "mix-decided"), n_buckets


def bucket(n_buckets: float) -> Column:
    """Position of the key on a scale without an end for low quality, in ``n_buckets`` steps a unit."""
    key = F.col("__llm_key")
    place = F.when(key < 1, key / (F.lit(1.0) + key)).otherwise(F.lit(0.5) + F.log2(key) / F.lit(6.0))
    return F.floor(place * F.lit(n_buckets))


def _times(wide: DataFrame, plan: DataFrame, decided: DataFrame, n_buckets: float) -> DataFrame:
    """``wide`` with ``__llm_times``: how often the mix takes each row.

    Only rows of the buckets in which a rest ends are joined with decisions.
    """
    source = ["__llm_src", "__llm_nosrc"]
    wide = wide.withColumn("__llm_bucket", bucket(n_buckets)).join(plan, source)
    sure = wide.where(F.col("__llm_bucket") != F.col("__llm_end")).withColumn(
        "__llm_times", F.col("__llm_epochs") + (F.col("__llm_bucket") < F.col("__llm_end")).cast("long"))
    key = [*source, "__llm_id", "__llm_noid", "__llm_hash"]
    open_ = wide.where(F.col("__llm_bucket") == F.col("__llm_end")).withColumns(
        {"__llm_id": F.coalesce("doc_id", F.lit(0).cast("long")), "__llm_noid": F.col("doc_id").isNull()})
    open_ = open_.join(decided, key).withColumn("__llm_times", F.col("__llm_epochs") + F.col("__llm_flag"))
    return sure.select(*wide.columns, "__llm_times").unionByName(open_.select(*wide.columns, "__llm_times"))


def mix_counts(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, fill_rounds: int = 4,
               quality: Column | None = None, lang: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``lang``, instead of ``quality``, names a column with the texts' languages: words are judged by
    the usual word length of their language, not by 6.
    """
    base, _ = _sizes(docs, quality, lang)
    plan, decided, n = _plan(base, weights, max_epochs, fill_rounds)
    return _times(base, plan, decided, n).select(
        "doc_id", F.when(~F.col("__llm_nosrc"), F.col("__llm_src")).alias("source"),
        F.col("__llm_size").alias("size"), "source_size", "target",
        (F.col("__llm_times") * F.col("__llm_size")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, fill_rounds: int = 4,
                  quality: Column | None = None, lang: str | None = None) -> DataFrame:
    """The mixed corpus: the rows of ``docs`` as often as the mix takes them, columns unchanged.

    The texts are read twice (sizes, then output) and only those in the
    deciding buckets are shuffled.  ``lang`` as in :func:`mix_counts`.
    """
    clash = [c for c in ("source_size", "target", "rest", "before") if c in docs.columns]
    renamed = docs.withColumnsRenamed({c: f"__llm_own_{c}" for c in clash})
    base, quality = _sizes(docs, quality, lang)
    plan, decided, n = _plan(base, weights, max_epochs, fill_rounds)
    out = _times(_prepared_once(renamed, quality), plan, decided, n).where("__llm_times > 0 and __llm_size > 0")
    out = out.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__llm_times"))))
    return out.select(*[F.col(f"__llm_own_{c}" if c in clash else c).alias(c) for c in docs.columns])
