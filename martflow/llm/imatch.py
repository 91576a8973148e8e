"""I-Match fingerprints: hashes of the mid-frequency terms of a text.

The lexicon holds the terms whose inverse document frequency lies in a band. It is
broadcast: as every term in it occurs in at least ``MIN_SHARE`` of all different texts, it has at
most (mean distinct terms of a text) / MIN_SHARE terms, however many texts there are.

Lexicon terms are dealt by their hash into subsets, at several densities: in the
densest scale each of ``CELLS`` subsets holds 1 / CELLS of the lexicon, and each
further scale keeps a quarter of the terms of the scale before. A text's fingerprint is
one hash per subset, over its distinct terms of the subset in order. Texts are alike to
the share of subsets, among those that either text has terms of, with equal hashes. The scale
with the largest share counts, as a long text has too many terms in a dense subset for
any edit to leave its hash alone, and a short text none in a sparse one.

A large group of near copies takes its own terms out of the band, and a text may have rarer
terms only. A text with too few terms in the band is known by its sketch instead: the ``SKETCH`` least
hashes of all its terms, dealt into ``CELLS`` subsets. A pair with such a text is compared by the
sketches of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.operators.keys import surrogate_keys
from martflow.llm import tables
from martflow.sources.workdir import store

#: The band, as shares of the different texts that have the term: an IDF from ln 12.5 to ln 1000.
MIN_SHARE, MAX_SHARE = 0.001, 0.08
SCALES, CELLS = 4, 16
#: Subsets that a scale must have terms in to count by itself.
LEAST_CELLS = 4
#: Terms of a sketch. A text needs so many terms in the band, and such a part of its terms, to do without.
SKETCH, FEW_TERMS, FEW_PART = 24, 8, 16
#: Stands for no term: each text has it, which keeps texts without lexicon terms.
_PRESENT = 0
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Hashes of the distinct words of a text, in lower case."""
    found = F.filter(F.split(F.lower(text), _SEPARATORS), lambda x: x != "")
    return F.array_distinct(F.transform(found, lambda x: F.xxhash64(x)))


def lexicon(
    df: DataFrame, text: str, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE
) -> DataFrame:
    """Hashes ``term`` of the terms in the band, counted over the different texts."""
    total = df.select(F.xxhash64(text)).distinct().count()
    counts = df.select(text).distinct().select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").count()
    band = counts.filter(
        (F.col("count") >= min_share * total) & (F.col("count") <= max_share * total)
    ).filter(F.col("count") > 1)
    return tables.store(band.select("term"), "lexicon")


def _mark(term: Column) -> Column:
    """The part of a term's hash that orders it for a sketch."""
    return F.shiftright(term, 32).cast("int")


def _sketch_cells(found: str) -> Column:
    """Subset hashes of a sketch, 0 for a subset without terms."""
    out = []
    for cell in range(CELLS):
        part = F.sort_array(F.filter(found, lambda x: x.bitwiseAND(F.lit(CELLS - 1)) == cell))
        out.append(F.when(F.size(part) > 0, _short(F.xxhash64(part))).otherwise(F.lit(0)))
    return F.array(*out)


def _short(mark: Column) -> Column:
    """The low bits of a hash, as a number that is not 0."""
    return F.greatest(mark.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"), F.lit(1))


def with_cells(df: DataFrame, found: str, name: str) -> DataFrame:
    """Adds the subset hashes of an array of distinct lexicon terms, 0 for a subset without terms.

    Each scale's terms are a column of their own, so that they are filtered once.
    """
    held = [c for c in df.columns]
    scaled = df.withColumn("scale0", F.sort_array(found))
    for i in range(1, SCALES):
        drop = F.lit((1 << (2 * i)) - 1)
        scaled = scaled.withColumn(f"scale{i}", F.filter(f"scale{i - 1}", lambda x: x.bitwiseAND(drop) == 0))
    out = []
    for i in range(SCALES):
        for cell in range(CELLS):
            mask = F.lit((CELLS - 1) << (8 + 4 * i))
            part = F.filter(f"scale{i}", lambda x: x.bitwiseAND(mask) == (cell << (8 + 4 * i)))
            out.append(F.when(F.size(part) > 0, _short(F.xxhash64(part))).otherwise(F.lit(0)))
    return scaled.select(*held, F.array(*out).alias(name))


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds the share of equal subset hashes, from 0 to 1; 1 for equal fingerprints."""
    held = [c for c in df.columns]

    def mark(x, y):
        return F.when((x == 0) & (y == 0), 0).when(x == y, 2).otherwise(1)

    marked = df.withColumn("marks", F.zip_with(a, b, mark))
    parts = [F.slice("marks", 1 + i * CELLS, CELLS) for i in range(SCALES)] + [F.col("marks")]
    marked = marked.select(
        "*",
        *[F.size(F.filter(x, lambda m: m > 0)).alias(f"full{i}") for i, x in enumerate(parts)],
        *[F.size(F.filter(x, lambda m: m > 1)).alias(f"same{i}") for i, x in enumerate(parts)],
    )
    least = [LEAST_CELLS] * SCALES + [1]
    shares = [
        F.when(F.col(f"full{i}") >= n, F.col(f"same{i}") / F.col(f"full{i}")).otherwise(0.0)
        for i, n in enumerate(least)
    ]
    alike = F.when(F.col(a) == F.col(b), 1.0).otherwise(F.greatest(*shares))
    return marked.select(*held, alike.alias(name))


def _with_near(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds the likeness of two texts, by their sketches where either has few terms in the band.

    A text is three columns, ``{a}print``, ``{a}sketch`` and ``{a}few``.
    """
    held = [c for c in df.columns]
    marks = F.zip_with(
        f"{a}sketch", f"{b}sketch", lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 2).otherwise(1)
    )
    marked = with_likeness(df.withColumn("sketch_marks", marks), f"{a}print", f"{b}print", "by_band")
    full = F.size(F.filter("sketch_marks", lambda m: m > 0))
    by_sketch = F.size(F.filter("sketch_marks", lambda m: m > 1)) / F.greatest(full, F.lit(1))
    near = F.when(F.col(f"{a}print") == F.col(f"{b}print"), 1.0)
    near = near.when(F.col(f"{a}few") | F.col(f"{b}few"), by_sketch).otherwise(F.col("by_band"))
    return marked.select(*held, near.alias(name))


def _shown(found: Column) -> Column:
    """Subset hashes as text: eight hex digits, or a dash for a subset without terms."""
    return F.array_join(
        F.transform(
            found,
            lambda x: F.when(x == 0, F.lit("-")).otherwise(
                F.lower(F.lpad(F.right(F.hex(x), F.lit(8)), 8, "0"))
            ),
        ),
        "",
    )


def _neighbours(plain: DataFrame) -> DataFrame:
    """Each document with its number and the document before it in key order, round the end."""
    keys = plain.select("none", "key", "mark", F.char_length("text").alias("size"))
    # a NULL key comes first
    numbered = surrogate_keys(
        keys.withColumn("rank", ~F.col("none")), ["rank", "key", "mark", "none", "size"], "id"
    )
    total = numbered.count()
    before = numbered.select(
        (F.col("id") % max(1, total) + 1).alias("id"),
        F.col("none").alias("none_before"),
        F.col("key").alias("key_before"),
        F.col("mark").alias("mark_before"),
        F.floor(F.col("size") / 4).cast("int").alias("wanted"),
    )
    return numbered.select("id", "none", "key", "mark").join(before, "id").withColumn(
        "next_id", F.col("id") % max(1, total) + 1
    )


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form and their likeness.

    The edited text ends, in place of its last quarter, with the beginning of the next
    document. Documents are ordered by key, NULL first, then by a hash of the text;
    rows with the same key and text are one document, and each gives its own row.
    NULL is the empty text. A text with few lexicon terms has its sketch for a fingerprint, and
    one without any terms the hash of the whole text, so it is like equal texts only.

    Returns ``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    plain = df.select(
        F.col(key).isNull().alias("none"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("key"),
        F.xxhash64(value).alias("mark"),
        value.alias("text"),
    )
    own = ["none", "key", "mark"]
    band = lexicon(plain, "text")
    found = plain.join(_neighbours(plain), own)
    heads = (
        found.select(
            F.col("none_before").alias("none"), F.col("key_before").alias("key"),
            F.col("mark_before").alias("mark"),
            F.substring(F.col("text"), F.lit(1), F.col("wanted")).alias("head"),
        )
        .groupBy(*own)
        .agg(F.max("head").alias("head"))
    )
    size = F.char_length("text")
    kept = F.substring(F.col("text"), F.lit(1), size - F.floor(size / 4).cast("int"))
    pairs = found.join(heads, own).select(
        *own, "id", "next_id", "text", size.cast("bigint").alias("n_chars"), F.concat(kept, "head").alias("edited")
    )
    each = pairs.select(
        *own, "id", "next_id", "n_chars", "text", "edited",
        F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("edited").alias("edited_mark"),
    ).select(
        *own, "id", "next_id", "n_chars", "edited_sha256", "edited_mark",
        F.explode(F.array(
            F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
            F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")),
        )).alias("x"),
    )
    each = each.select("*", F.col("x.which").alias("which"), terms(F.col("x.text")).alias("terms")).drop("x")
    ranked = F.sort_array(F.transform("terms", _mark))
    # before the terms are exploded, as each of their rows would hold them all otherwise
    each = each.select(
        "*",
        F.size("terms").alias("many"),
        F.get(ranked, F.least(F.size("terms"), F.lit(SKETCH)) - 1).alias("last"),
    )
    each = each.withColumn("term", F.explode(F.concat(F.array(F.lit(_PRESENT).cast("bigint")), F.col("terms"))))
    each = each.drop("terms")
    spark = df.sparkSession
    band = band.unionByName(spark.range(_PRESENT, _PRESENT + 1).select(F.col("id").alias("term"))).distinct()
    # at most (mean distinct terms of a text) / MIN_SHARE terms
    each = each.join(F.broadcast(band.withColumn("known", F.lit(True))), "term", "left")
    low = (F.col("term") != _PRESENT) & (_mark(F.col("term")) <= F.col("last"))
    each = each.withColumn("low", F.coalesce(low, F.lit(False))).filter("known OR low")

    def gathered(which, wanted, value):
        mine = (F.col("which") == which) & (F.col("term") != _PRESENT) & F.col(wanted)
        return F.collect_set(F.when(mine, value))

    once = (F.col("which") == 0) & (F.col("term") == _PRESENT)
    facts = ["id", "next_id", "n_chars", "edited_sha256", "edited_mark"]
    sets = each.groupBy(*own).agg(
        gathered(0, "known", F.col("term")).alias("own"),
        gathered(1, "known", F.col("term")).alias("edit"),
        gathered(0, "low", _mark(F.col("term"))).alias("own_low"),
        gathered(1, "low", _mark(F.col("term"))).alias("edit_low"),
        F.max(F.when(F.col("which") == 0, F.col("many"))).alias("own_many"),
        F.max(F.when(F.col("which") == 1, F.col("many"))).alias("edit_many"),
        F.count(F.when(once, 1)).alias("rows"),
        *[F.max(F.when(once, F.col(c))).alias(c) for c in facts],
    )

    def few(found, many):
        return F.size(found) < F.greatest(F.lit(FEW_TERMS), F.col(many) / FEW_PART)

    def whole(few, cells, sketch, many, mark):
        """Subset hashes, those of the sketch, or the text's hash in the first two places."""
        low, high = _short(F.col(mark)), _short(F.shiftrightunsigned(mark, 31))
        alone = F.concat(F.array(low, high), F.array_repeat(F.lit(0), SCALES * CELLS - 2))
        sketched = F.concat(F.col(sketch), F.array_repeat(F.lit(0), (SCALES - 1) * CELLS))
        return F.when(~F.col(few), F.col(cells)).when(F.col(many) > 0, sketched).otherwise(alone)

    marked = with_cells(with_cells(sets, "own", "cells"), "edit", "edited_cells").select(
        "*",
        _sketch_cells("own_low").alias("sketch"), _sketch_cells("edit_low").alias("edited_sketch"),
        few("own", "own_many").alias("few"), few("edit", "edit_many").alias("edited_few"),
    )
    marked = marked.select(
        *own, *facts, "rows", "sketch", "few", "edited_sketch", "edited_few",
        whole("few", "cells", "sketch", "own_many", "mark").alias("print"),
        whole("edited_few", "edited_cells", "edited_sketch", "edit_many", "edited_mark").alias("edited_print"),
    )
    marked = store(marked, "prints")
    following = marked.select(
        F.col("id").alias("next_id"), *[F.col(c).alias(f"next_{c}") for c in ("print", "sketch", "few")]
    )
    alike = _with_near(marked, "", "edited_", "near_edited").drop("edited_sketch", "edited_few").join(following, "next_id")
    alike = _with_near(alike, "", "next_", "near_next")
    return alike.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows"))).select(
        F.when(~F.col("none"), F.col("key")).alias(key),
        "n_chars",
        "edited_sha256",
        _shown(F.col("print")).alias("fingerprint"),
        _shown(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
