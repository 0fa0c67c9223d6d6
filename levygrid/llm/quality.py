"""Document quality with rules enforced by host.

Every document is measured against a few rules. Failures are counted by host, and the
failure rates are shrunk towards the corpus by a beta prior fitted to the hosts' own rates,
so that a host with few documents isn't judged by chance. A host where a rule
fails often gets this rule enforced: its documents that break it go. Where a rule hardly ever
fails, a failure is taken for a false alarm. A host that fails nearly always is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from levygrid.llm.common import fresh, let, numbered, Scratch, SPACE_CLASS, words_of
from levygrid.operators.lookup import Dimension, lookup_join

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Thresholds of documents and hosts."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    #: Fewer repeated lines are never a failure: in a text of three lines one is a third.
    min_dup_lines: int = 3
    min_word_chars: int = 3
    max_word_chars: int = 10
    #: A rule is enforced at hosts with at least this shrunk failure rate.
    enforce_rate: float = 0.02
    #: A host is blocked if its documents break any rule at this shrunk rate.
    block_rate: float = 0.9
    #: Prior strength where the hosts' rates show no spread.
    flat_strength: float = 1e6
    broadcast_bytes: int = 32 << 20
    salts: int = 64


def _repeat_words(words: Column) -> Column:
    """Words in five-word windows that occur twice or more, each word once.

    Windows are compared by 64-bit hashes, within one text only. Sorted (hash, place)
    pairs bring equal windows together; texts without any skip the sort.
    """
    n = F.size(words)

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(pairs: Column) -> Column:
            def twin(e: Column, k: Column) -> Column:
                before = F.get(pairs, k - 1)["h"]
                after = F.get(pairs, k + 1)["h"]
                return F.coalesce(before == e["h"], F.lit(False)) | F.coalesce(after == e["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(pairs, twin), lambda e: e["i"]))

        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))
        total = F.aggregate(
            let(ordered, places), start,
            lambda acc, at: F.struct(
                (acc["sum"] + _WINDOW - F.greatest(F.lit(0), acc["end"] - at)).alias("sum"),
                (at + _WINDOW).alias("end"),
            ),
            lambda acc: acc["sum"],
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(total)

    windows = F.transform(
        F.sequence(F.lit(0), n - _WINDOW),
        lambda i: F.xxhash64(*[words[i + k] for k in range(_WINDOW)]),
    )
    return F.when(n >= _WINDOW, let(windows, covered)).otherwise(0)


def measures(text: Column) -> Column:
    """Struct of the counts in ``MEASURES`` (long) of a whole text; a null text has none.

    Built-in functions only; each array is made once for a row.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.regexp_replace(line, f"{SPACE_CLASS}++", "")) > 0
    )
    in_words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")
    ))
    in_lines = let(lines, lambda l: F.struct(
        F.size(l).cast("long").alias("n_lines"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
    ))
    return F.struct(
        in_words.alias("w"), in_lines.alias("l"),
        F.length(F.regexp_replace(text, f"{SPACE_CLASS}++", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
    )


def _flat(m: Column) -> dict[str, Column]:
    return {
        "n_words": m["w"]["n_words"], "word_chars": m["word_chars"], "n_symbols": m["n_symbols"],
        "n_dup_lines": m["l"]["n_dup_lines"], "n_repeat_words": m["w"]["n_repeat_words"],
        "n_lines": m["l"]["n_lines"],
    }


def failures(m: dict[str, Column], rules: Rules) -> dict[str, Column]:
    """Rule name to whether a document with measures ``m`` breaks it."""
    words = m["n_words"]
    return {
        "base": (words < rules.min_words)
        | (100 * m["n_repeat_words"] > rules.max_repeat_percent * words),
        "symbols": 100 * m["n_symbols"] > rules.max_symbol_percent * words,
        "lines": (m["n_dup_lines"] >= rules.min_dup_lines)
        & (100 * m["n_dup_lines"] > rules.max_dup_line_percent * m["n_lines"]),
        "length": (m["word_chars"] < rules.min_word_chars * words)
        | (m["word_chars"] > rules.max_word_chars * words),
    }


def host_key(host: Column) -> Column:
    """A key without nulls; rows without host share one."""
    return F.when(host.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), host.cast("string")))


def host_verdicts(failed: DataFrame, names: list[str], rules: Rules) -> DataFrame:
    """(host, enforced array, blocked) of hosts with a verdict against them.

    ``failed`` has ``host`` and a boolean column for each rule in ``names``. The prior's two
    parameters are moments of the hosts' rates: one row of sums reaches the driver. Hosts
    without a verdict are left out, so the result is as small as the number of bad hosts.
    """
    scratch = Scratch(failed.sparkSession)
    any_rule = F.greatest(*[F.col(n) for n in names])
    counts = scratch.write(failed.withColumn("any", any_rule).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(r).cast("long")).alias(r) for r in [*names, "any"]],
    ))
    moments = counts.agg(*[
        f(F.col(r) / F.col("n")).alias(f"{label}_{r}")
        for r in [*names, "any"] for f, label in ((F.avg, "mean"), (F.var_pop, "spread"))
    ]).first()

    def shrunk(rule: str) -> Column:
        mean, spread = moments[f"mean_{rule}"] or 0.0, moments[f"spread_{rule}"] or 0.0
        strength = mean * (1 - mean) / spread - 1 if spread > 0 else rules.flat_strength
        strength = max(strength, 1.0)
        return (F.col(rule) + mean * strength) / (F.col("n") + strength)

    enforced = F.array_compact(F.array(*[
        F.when(shrunk(r) >= rules.enforce_rate, F.lit(r)) for r in names
    ]))
    return counts.select(
        "host", enforced.alias("enforced"), (shrunk("any") >= rules.block_rate).alias("blocked")
    ).where((F.size("enforced") > 0) | F.col("blocked"))


def _judged(df: DataFrame, text_col: str, host_col: str, rules: Rules, keep: list[str]):
    """Rows of ``df`` (columns ``keep``) with measures, ``base`` and ``kept``, under new names.

    Documents are measured once and written; hosts are counted from the narrow columns.
    Verdicts are broadcast if their measured size allows, else joined with salted keys.
    """
    names = fresh(df, *MEASURES, "base", "symbols", "lines", "length", "host", "kept", "__m", "__row")
    new = dict(zip([*MEASURES, "base", "symbols", "lines", "length", "host", "kept", "__m", "__row"], names))
    scratch = Scratch(df.sparkSession)
    measured = (
        df.withColumn(new["__m"], measures(F.col(text_col)))
        .select(*keep, host_key(F.col(host_col)).alias(new["host"]),
                *[c.alias(new[n]) for n, c in _flat(F.col(new["__m"])).items()])
    )
    broken = failures({n: F.col(new[n]) for n in MEASURES}, rules)
    rules_of = list(broken)
    measured = scratch.write(measured.select("*", *[c.alias(new[r]) for r, c in broken.items()]))
    verdicts = host_verdicts(
        measured.select(F.col(new["host"]).alias("host"), *[F.col(new[r]).alias(r) for r in rules_of]),
        rules_of, rules,
    ).withColumnsRenamed({"host": "__host", "enforced": "__enforced", "blocked": "__blocked"})
    dim = Dimension(verdicts, ["__host"], rules.broadcast_bytes, rules.salts)
    spread = [new[m] for m in MEASURES]
    joined = lookup_join(measured, dim, {"__host": F.col(new["host"])}, "left", spread)
    broke_enforced = F.lit(False)
    for r in rules_of:
        broke_enforced |= F.col(new[r]) & F.coalesce(F.array_contains("__enforced", r), F.lit(False))
    kept = ~(F.col(new["base"]) | F.coalesce("__blocked", F.lit(False)) | broke_enforced)
    return joined.withColumn(new["kept"], kept), new


def assess(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    rules: Rules = Rules(),
) -> DataFrame:
    """(doc_id, five measures, base_failed, kept), a row for each row of ``df``.

    Null and empty texts have no words and fail the base rule. Rows without a host count
    as one host. Repeated rows are judged alike. Other columns of ``df`` are not read.
    """
    df = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("source"))
    judged, new = _judged(df, "text", "source", rules, ["doc_id"])
    return judged.select(
        "doc_id", *[F.col(new[m]).alias(m) for m in MEASURES[:5]],
        F.col(new["base"]).alias("base_failed"), F.col(new["kept"]).alias("kept"),
    )


def accepted(
    df: DataFrame, text_col: str = "text", host_col: str = "source", rules: Rules = Rules()
) -> DataFrame:
    """Rows of ``df`` that neither the base rules nor their host's verdict reject.

    Null and empty texts go, as they fail the base rule. Rows without a host are one host. Repeated rows
    stay or go together, an empty table gives an empty one, and columns of ``df`` may have any names.
    """
    names = df.columns
    df, (text_col, host_col) = numbered(df, text_col, host_col)
    judged, new = _judged(df, text_col, host_col, rules, df.columns)
    return judged.where(F.col(new["kept"])).select(*df.columns).toDF(*names)
