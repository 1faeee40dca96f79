"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests finds, in Spark SQL only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, as (kind, pattern, group whose length counts, least length).
# `(?i:...)` knows no letters beyond A-Z here.
BASE = [
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
KINDS = [kind for kind, *_ in BASE] + ["random"]
RANDOM = KINDS.index("random")

# The alphabets a token can be written in, the narrowest first, with the chance that
# two characters of ordinary text in that alphabet agree, and that three do.
ALPHABETS = [
    (r"^[0-9]+$", "0123456789", 0.16, 0.034),
    (r"^[0-9a-f]+$", "0123456789abcdef", 0.12, 0.019),
    (r"^[0-9A-F]+$", "0123456789ABCDEF", 0.12, 0.019),
    (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.068, 0.0058),
    (r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.068, 0.0058),
]
# Tokens tested, and the lengths at which a new band of equal power begins.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
BANDS = [16, 20, 28, 40, 64, 128]
# Share of false finds allowed in a band, and the level at which runs and correlation veto.
FALSE_SHARE = 0.05
VETO = 0.001
# Steps of -log10 of p: a tenth each, and no further than p = 1e-30.
TOP_STEP = 300

SPANS = "array<struct<start:int,kind:int,end:int>>"
TESTED = "array<struct<start:int,end:int,band:int,step:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _located(text: Column, pattern: str, group: int = 0) -> Column:
    """Every match of a pattern as (start, end, token, counted): token is the whole, counted a group.

    A split leaves the gaps between matches; gaps and matches in turn give each match its place.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.zip_with(
        F.split(text, pattern, -1),
        F.arrays_zip(whole.alias("token"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("counted")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), m["token"].alias("token"), m["counted"].alias("counted")),
    )
    kind = "array<struct<start:int,end:int,token:string,counted:string>>"
    placed = F.aggregate(
        F.filter(found, lambda m: m["token"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("matches")),
        lambda done, m: _let(
            done["at"] + m["gap"],
            lambda start: F.struct(
                (start + F.length(m["token"])).alias("at"),
                F.array_append(
                    done["matches"],
                    F.struct(
                        start.alias("start"),
                        (start + F.length(m["token"])).alias("end"),
                        m["token"].alias("token"),
                        m["counted"].alias("counted"),
                    ),
                ).alias("matches"),
            ),
        ),
    )["matches"]
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(kind))


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns, ordered by start and then kind."""
    kinds = []
    for order, (_, pattern, group, least) in enumerate(BASE):
        if group == 0:
            # A greedy run that is too short holds no longer match, so the bound can stand in the pattern.
            pattern = pattern.removesuffix("+") + f"{{{least - (4 if pattern.startswith('AKIA') else 0)},}}"
        matches = F.filter(_located(text, pattern, group), lambda m: F.length(m["counted"]) >= least)
        kinds.append(F.transform(matches, lambda m: _span(m, order)).cast(SPANS))
    return F.array_sort(F.concat(*kinds))


def _span(match: Column, kind: int) -> Column:
    return F.struct(match["start"].alias("start"), F.lit(kind).alias("kind"), match["end"].alias("end"))


def battery(token: Column) -> Column:
    """The tests of one token, as (length, chi_square, p_text, p_runs, p_serial).

    The encoding is the narrowest alphabet that holds the token. `chi_square` is its distance from
    an even use of that alphabet. Ordinary text lies far off, the farther the longer it is, and
    `p_text` is the chance that text of this length and alphabet comes out as even as the token.
    `p_runs` (runs above and below the alphabet's middle) and `p_serial` (correlation of neighbours)
    are the chances that a random token gives such values; sequences and repetitions do not.
    """
    plain = F.translate(token, "-_", "+/")
    choose = lambda t, values: F.coalesce(
        *[F.when(t.rlike(a[0]), v) for a, v in zip(ALPHABETS, values)]
    )
    return _let(
        plain,
        lambda t: _let(
            F.struct(
                t.alias("t"),
                F.length(t).cast("double").alias("n"),
                choose(t, [F.lit(a[1]) for a in ALPHABETS]).alias("alphabet"),
                choose(t, [F.lit(float(len(a[1]))) for a in ALPHABETS]).alias("size"),
                choose(t, [F.lit(a[2]) for a in ALPHABETS]).alias("two"),
                choose(t, [F.lit(a[3]) for a in ALPHABETS]).alias("three"),
            ),
            lambda x: _let(_statistics(x), lambda s: _chances(x, s)),
        ),
    )


def _statistics(x: Column) -> Column:
    characters = F.split(x["t"], "")
    values = F.transform(characters, lambda c: F.instr(x["alphabet"], c) - 1.0 - (x["size"] - 1) / 2)
    times = lambda c: x["n"] - F.length(F.replace(x["t"], c, F.lit("")))
    squares = _total(F.transform(F.array_distinct(characters), lambda c: F.pow(times(c), F.lit(2.0))))
    return _let(
        values,
        lambda v: _let(
            F.zip_with(
                F.slice(v, 1, F.size(v) - 1),
                F.slice(v, 2, F.size(v)),
                lambda a, b: F.struct((a * b).alias("product"), ((a > 0) != (b > 0)).cast("double").alias("turn")),
            ),
            lambda pairs: F.struct(
                (x["size"] / x["n"] * squares - x["n"]).alias("chi_square"),
                _total(F.transform(v, lambda a: (a > 0).cast("double"))).alias("above"),
                (1 + _total(F.transform(pairs, lambda p: p["turn"]))).alias("runs"),
                _total(F.transform(pairs, lambda p: p["product"])).alias("products"),
            ),
        ),
    )


def _chances(x: Column, s: Column) -> Column:
    n, size, two, three = x["n"], x["size"], x["two"], x["three"]
    expected = size * (1 + (n - 1) * two) - n
    spread = 2 * size / n * F.sqrt(n * (n - 1) / 2 * two * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two))
    mean_runs = 1 + 2 * s["above"] * (n - s["above"]) / n
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    serial = s["products"] / ((size * size - 1) / 12) / F.sqrt(n - 1)
    return F.struct(
        n.cast("int").alias("length"),
        s["chi_square"].alias("chi_square"),
        _below((s["chi_square"] - expected) / spread).alias("p_text"),
        F.when(var_runs > 0, _beyond((s["runs"] - mean_runs) / F.sqrt(var_runs))).otherwise(0.0).alias("p_runs"),
        _beyond(serial).alias("p_serial"),
    )


def _below(z: Column) -> Column:
    """The normal distribution's share below z, by its logistic approximation."""
    return 1 / (1 + F.exp(-(0.07056 * z * z * z + 1.5976 * z)))


def _beyond(z: Column) -> Column:
    return 2 * _below(-F.abs(z))


def tested_tokens(text: Column) -> Column:
    """Every token long enough, as (start, end, band, step): `step` is -log10 of its p in tenths.

    p is `p_text`, or 1 where a veto holds.
    """

    def outcome(m: Column, b: Column) -> Column:
        p = F.when((b["p_runs"] < VETO) | (b["p_serial"] < VETO), 1.0).otherwise(F.greatest(b["p_text"], F.lit(1e-30)))
        band = F.lit(BANDS[0])
        for least in BANDS[1:]:
            band = F.when(b["length"] >= least, F.lit(least)).otherwise(band)
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            band.alias("band"),
            F.least(F.floor(-10 * F.log10(p)).cast("int"), F.lit(TOP_STEP)).alias("step"),
        )

    return F.transform(
        _located(text, CANDIDATE), lambda m: _let(battery(m["token"]), lambda b: outcome(m, b))
    ).cast(TESTED)


def free_tokens(text: Column, base: Column) -> Column:
    """The tested tokens that no base span touches; the others are found as they are."""
    touched = lambda t: F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return F.filter(tested_tokens(text), lambda t: ~touched(t))


def discovery_steps(docs: DataFrame, text_col: str = "text", false_share: float = FALSE_SHARE) -> dict[int, int]:
    """Per band, the least step at which a token counts as found.

    Benjamini and Hochberg's rule over all tokens of the band in the whole table that no base span
    touches: the longer a token, the smaller p gets for a random one, so long tokens are not held to
    the level that short ones need, and secrets found by their pattern do not lower it. The counts by
    band and step are at most 6 x 301 rows whatever the table's size, and only they reach the driver.
    A band in which nothing is found is absent.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    steps = (
        docs.select(F.explode(_let(base_spans(text), lambda base: free_tokens(text, base))).alias("_t"))
        .groupBy(F.col("_t.band").alias("band"), F.col("_t.step").alias("step"))
        .agg(F.count(F.lit(1)).alias("tokens"))
        .collect()
    )
    least: dict[int, int] = {}
    for band in BANDS:
        counts = {r.step: r.tokens for r in steps if r.band == band}
        total, found = sum(counts.values()), 0
        for step in sorted(counts, reverse=True):
            found += counts[step]
            if total * 10 ** (-step / 10) <= false_share * found:
                least[band] = step
    return least


def with_spans(docs: DataFrame, text_col: str = "text", steps: dict[int, int] | None = None) -> DataFrame:
    """`docs` with `_base` and `_spans`, arrays of (start, kind, end) by start and then kind.

    Places are in code points, end exclusive. `_spans` adds the tokens found by the battery that no
    base span touches. A null or empty text has no spans.
    """
    if steps is None:
        steps = discovery_steps(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumn("_base", base_spans(text))
    if not steps:
        return found.withColumn("_spans", F.col("_base"))

    def discovered(t: Column) -> Column:
        level = F.lit(TOP_STEP + 1)
        for band, step in steps.items():
            level = F.when(t["band"] == band, F.lit(step)).otherwise(level)
        return t["step"] >= level

    added = F.transform(F.filter(free_tokens(text, F.col("_base")), discovered), lambda t: _span(t, RANDOM))
    return found.withColumn("_spans", F.array_sort(F.concat("_base", added.cast(SPANS))))


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Two passes over the texts, without a shuffle but for the counts of `discovery_steps`. Texts that
    repeat are scanned each for itself; null ids are passed on; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    count = lambda spans, kind: F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return with_spans(rows, "_text").select(
        "doc_id",
        *[count(F.col("_base"), kind).alias(f"n_{kind}") for kind in KINDS[:RANDOM]],
        F.sha2(span_list(F.col("_base")), 256).alias("base_sha256"),
        span_list(F.col("_spans")).alias("spans"),
        count(F.col("_spans"), "random").alias("n_random"),
    )


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of a secret replaced by `mark`; other texts and all columns stay.

    Spans that touch or overlap become one mark. `n_chars`, where there is one, follows the text. A null
    text stays null and an empty one empty; ids are not looked at, so null and repeated ones change
    nothing, and equal texts are cut alike. An empty table stays empty.
    """
    text = F.col(text_col)
    cut = F.aggregate(
        F.col("_spans"),
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] < acc["at"], acc["done"])
            .otherwise(F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    clean = with_spans(docs, text_col).withColumn(text_col, F.when(F.size("_spans") > 0, cut).otherwise(text))
    if "n_chars" in docs.columns:
        length = F.when(F.size("_spans") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", length)
    return clean.select(*docs.columns)
