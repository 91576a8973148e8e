"""Quality rules of documents, and verdicts on the hosts that they come from.

Everything is a column function or a grouping. A document's counts come from one pass over its
text. Its 3-word windows are compared by hashes; where some are equal, they are sorted together with
their places, so that equal windows lie side by side and the work grows with ``n log n`` of the words. Hosts are judged by the share of their
documents that fail a rule. A host of few documents tells little by itself, so each share is
drawn towards that of all documents by a beta prior, whose strength follows from how much the
shares of the hosts differ (method of moments). The counts are stored once; the table of hosts,
which is as long as there are hosts, is joined back to them by a join that checks its size and
spreads hot hosts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.tables import store
from martflow.operators.joins import DEFAULT_SKEW, Skew, lookup_join

# fixed values: spaces between words, symbols, and the limits of the base rules
_WORD = r"[^\x20\x09-\x0D]++"
_SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3

#: A host is condemned by a rule that more than this share of its documents fails, as shrunk.
MAX_RATE = 0.5
#: Bounds of the prior's strength, in documents. The lower one keeps a few documents from
#: condemning their host where other hosts differ wholly.
LEAST_STRENGTH, MOST_STRENGTH = 10.0, 1e6

#: Rules by name; each is true for documents that fail it. The first two are the base rules.
RULES: dict[str, str] = {
    "few_words": f"n_words < {LEAST_WORDS}",
    "repeated_words": f"100 * n_repeat_words > {REPEATED_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE_RULES = ("few_words", "repeated_words")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def host_of(source: Column) -> Column:
    """The host of a URL in lower case, without user, port and ``www``; other texts as they are.

    NULL and the empty text are no host.
    """
    host = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    named = F.regexp_replace(F.lower(host), r"^www\.", "")
    return F.nullif(F.when(host != "", named).otherwise(source), F.lit(""))


def text_counts(df: DataFrame, text: Column, *kept: Column) -> DataFrame:
    """The columns *kept* and ``COUNTS`` of every text.

    ``n_lines`` are the lines with a word, ``n_dup_lines`` those equal to an earlier one,
    ``n_repeat_words`` the words inside windows of three words that occur twice or more.
    NULL counts as the empty text, which has none of anything.
    """
    value = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(value, "\n", -1), lambda x: x.rlike(_WORD))
    # a column of its own for each step: an array that is used twice isn't made twice
    split = df.select(
        *kept,
        F.regexp_count(value, F.lit(_SYMBOL)).cast("bigint").alias("n_symbols"),
        lines.alias("__lines"),
        F.regexp_extract_all(value, F.lit(_WORD), F.lit(0)).alias("__words"),
    )
    names = split.columns[:-2]
    words, n = F.col("__words"), F.size("__words")
    hashes = F.transform(
        F.slice(words, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get(words, i + k) for k in range(1, WINDOW))),
    )
    counted = split.select(
        *names,
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        n.cast("bigint").alias("n_words"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        words,
        hashes.alias("__hashes"),
    )
    names = counted.columns[:-2]
    # most texts end here: without equal hashes there are no equal windows
    placed = F.sort_array(F.transform("__hashes", lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
    repeated = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    sorted_ = counted.select(*names, words, F.when(repeated, placed).alias("__placed"))
    maybe = sorted_.select(*names, words, _with_equal_neighbour("__placed").alias("__maybe"))
    # equal hashes are settled by the words themselves
    window = F.transform(
        "__maybe",
        lambda i: F.struct(F.concat_ws(" ", *(F.get(words, i + k) for k in range(WINDOW))).alias("w"), i.alias("i")),
    )
    windows = maybe.select(*names, F.sort_array(window).alias("__windows"))
    found = windows.select(*names, F.sort_array(_with_equal_neighbour("__windows")).alias("__starts"))
    # a window adds the words that the one before it does not reach
    reach = F.aggregate(
        "__starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("sum")),
        lambda acc, x: F.struct(
            x.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("sum")
        ),
        lambda acc: acc["sum"],
    )
    return found.select(*names, F.coalesce(reach, F.lit(0).cast("bigint")).alias("n_repeat_words"))


def _with_equal_neighbour(name: str) -> Column:
    """Places ``i`` of the entries ``(w, i)`` of a sorted array whose ``w`` stands next to an equal one."""
    entries = F.col(name)

    def place(x: Column, j: Column) -> Column:
        return F.when((F.get(entries, j - 1)["w"] == x["w"]) | (F.get(entries, j + 1)["w"] == x["w"]), x["i"])

    return F.filter(F.transform(entries, place), lambda x: x.isNotNull())


def rule_counts(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Stored ``(key, host, counts)``, a row for each row of *df*, and so one pass over the texts."""
    counts = text_counts(df, F.col(text), F.col(key).alias("key"), host_of(F.col(host)).alias("host"))
    return store(counts.select("key", "host", *COUNTS), "rule-counts")


def host_rates(counts: DataFrame) -> DataFrame:
    """Per host: documents, failing documents and shrunk failure rate of every rule.

    With ``f`` of ``n`` documents failing, the rate is ``(f + s * m) / (n + s)``, where ``m`` is the share
    of all documents and ``s`` the strength of the prior. Between hosts the shares vary by what
    is left of their weighted variance when the variance of drawing ``n`` documents is taken off; ``s`` is
    ``m (1 - m)`` over that, less one. Where nothing is left, ``s`` is at its upper bound.
    Documents without a host form none.
    """
    hosts = counts.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.count_if(F.expr(rule)).alias(f"failed_{name}") for name, rule in RULES.items()],
    )
    hosts = store(hosts, "hosts")
    n, all_ = F.col("documents").cast("double"), {}
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("n2"),
        *[F.sum(f"failed_{r}").alias(f"f_{r}") for r in RULES],
        *[F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / n).alias(f"q_{r}") for r in RULES],
    ).first()
    for rule in RULES:
        all_[rule] = prior(sums["hosts"], sums["n"], sums["n2"], sums[f"f_{rule}"], sums[f"q_{rule}"])
    rates = [
        ((F.col(f"failed_{r}") + F.lit(s * m)) / (n + F.lit(s))).alias(f"rate_{r}")
        for r, (m, s) in all_.items()
    ]
    return hosts.select("*", *rates)


def prior(hosts: int, n: float | None, n2: float | None, failed: int | None, squares: float | None) -> tuple[float, float]:
    """Mean and strength of the beta prior, from sums over the hosts: documents, their squares,
    failing documents, and their squares over documents."""
    if not hosts:
        return 0.0, LEAST_STRENGTH
    mean = failed / n
    own = mean * (1 - mean)
    room = n - n2 / n
    between = (squares - failed * failed / n - (hosts - 1) * own) / room if room > 0 else 0.0
    if between <= 0:
        return mean, MOST_STRENGTH
    return mean, min(max(own / between - 1, LEAST_STRENGTH), MOST_STRENGTH)


def quality_rules(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_rate: float = MAX_RATE,
    skew: Skew = DEFAULT_SKEW,
) -> DataFrame:
    """``(key, host, counts, base_failed, failed, host_failed, kept)``, a row for each row of *df*.

    ``failed`` and ``host_failed`` name the rules that the document fails, and those by which its
    host is condemned. A document is kept if it fails no base rule and no rule condemns its
    host. NULL texts count as empty, and fail; documents without a host (NULL or empty) are
    judged alone. Rows that are repeated, or share a key, are documents of their own; a NULL key stays
    NULL. Other columns of *df*, whatever their names, are left out. An empty table gives none.
    """
    counts = rule_counts(df, key, text, host)
    rates = host_rates(counts)
    condemned = [F.when(F.col(f"rate_{r}") > max_rate, F.lit(r)) for r in RULES]
    verdicts = store(
        rates.select("host", "documents", F.array_compact(F.array(*condemned)).alias("host_failed")), "verdicts"
    )
    weights = verdicts.select("host", F.col("documents").alias("rows"))
    joined = lookup_join(counts, verdicts.drop("documents"), "host", counts=weights, skew=skew)
    none = F.array().cast("array<string>")
    failed = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in RULES.items()]))
    base = reduce(lambda a, b: a | b, (F.expr(RULES[r]) for r in BASE_RULES))
    judged = joined.select(
        F.col("key").alias(key), F.col("host"), *COUNTS, base.alias("base_failed"), failed.alias("failed"),
        F.coalesce("host_failed", none).alias("host_failed"),
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("host_failed") == 0))
