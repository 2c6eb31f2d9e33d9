"""Secrets by strict patterns and by a battery of randomness tests.

Long strings of letters and digits are put to three tests of the hypothesis that they
are uniformly random over their encoding's alphabet: chi-squared for the frequencies,
runs above and below the middle, and lag-1 serial correlation. Random strings have
p-values spread evenly over 0 to 1; ordinary ones crowd near 0, the more so the longer
they are. So in each class of lengths the p-values above one half tell how many random
strings there are, and the threshold is the lowest at which the flagged ones are
almost all accounted for by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import fresh_name, prefix_sums, whole_text
from clickloom.workspace import materialise

# The base kinds in the order in which spans are listed.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: Strings that are put to the tests.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"

# Encodings, the first that fits is inferred, with their alphabets in order.
ENCODINGS = (
    ("[0-9a-f]+", "0123456789abcdef"),
    ("[0-9A-F]+", "0123456789ABCDEF"),
    ("[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("[A-Z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("[A-Za-z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("[A-Za-z0-9+/]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("[A-Za-z0-9_-]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Classes of lengths by their lower ends.
LENGTH_CLASSES = (20, 28, 40, 64, 128)
#: Steps of the thresholds, and the lowest one.
BINS, LOWEST = 100, 1


def _spans(text: Column, pattern: str, kind: str, holds=None) -> Column:
    """Sorted array of (start, end, kind, value) of a pattern's matches that hold.

    A match starts after all that lies between the matches before it and after these.
    Only texts that have a match are split.
    """
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    lengths = F.transform(found, F.length)
    gaps = F.slice(between, 1, F.size(found))
    rows = F.arrays_zip(
        gaps.alias("gap"),
        lengths.alias("length"),
        prefix_sums(F.zip_with(gaps, lengths, lambda a, b: a + b)).alias("before"),
        found.alias("value"),
        F.regexp_extract_all(text, regex, F.lit(2)).alias("group")
        if kind == "assign"
        else found.alias("group"),
    )
    if holds is not None:
        rows = F.filter(rows, holds)
    spans = F.transform(
        rows,
        lambda x: F.struct(
            (x.before + x.gap).alias("start"),
            (x.before + x.gap + x.length).alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            x.value.alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>")
    )


def _upper_tail(z: Column) -> Column:
    """Chance that a standard normal exceeds z (polynomial approximation, error below 1e-6)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    terms = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    series = F.lit(0.0)
    for c in reversed(terms):
        series = (series + c) * t
    half = series * F.exp(-x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def randomness(tokens: DataFrame) -> DataFrame:
    """``tokens`` (column ``value``) with ``p``: how compatible it is with a random string.

    Three times the least of the p-values of the tests, at most 1. Strings of only
    letters or only digits fit no encoding and get null, as do mixtures of alphabets.
    """
    alphabet = F.coalesce(
        *[F.when(F.col("value").rlike(f"^{form}$"), F.lit(a)) for form, a in ENCODINGS]
    )
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    coded = (
        tokens.withColumn("alphabet", F.when(mixed, alphabet))
        .withColumn("k", F.length("alphabet").cast("double"))
        .withColumn("n", F.length("value").cast("double"))
        .withColumn(
            "codes",
            F.expr("transform(split(value, ''), c -> cast(instr(alphabet, c) AS double))"),
        )
    )
    squares = F.expr(
        "aggregate(array_distinct(codes), 0D,"
        " (a, c) -> a + pow(size(filter(codes, x -> x = c)), 2))"
    )
    moments = (
        coded.withColumn("squares", squares)
        .withColumn("mean", F.expr("aggregate(codes, 0D, (a, x) -> a + x) / n"))
        .withColumn("n1", F.expr("cast(size(filter(codes, x -> x > k / 2)) AS double)"))
        .withColumn(
            "runs",
            F.expr(
                "1 + aggregate(zip_with(slice(codes, 1, size(codes) - 1),"
                " slice(codes, 2, size(codes)), (a, b) -> (a > k / 2) <> (b > k / 2)),"
                " 0D, (s, x) -> s + int(x))"
            ),
        )
        .withColumn(
            "variance", F.expr("aggregate(codes, 0D, (a, x) -> a + (x - mean) * (x - mean))")
        )
        .withColumn(
            "covariance",
            F.expr(
                "aggregate(zip_with(slice(codes, 1, size(codes) - 1),"
                " slice(codes, 2, size(codes)), (a, b) -> (a - mean) * (b - mean)),"
                " 0D, (s, x) -> s + x)"
            ),
        )
    )
    n, k, n1 = F.col("n"), F.col("k"), F.col("n1")
    chi = k / n * F.col("squares") - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))  # k and n are well above 1
    expected = 2 * n1 * (n - n1) / n + 1
    spread = F.sqrt((expected - 1) * (expected - 2) / (n - 1))
    p_runs = F.when((n1 < 2) | (n - n1 < 2), 0.0).otherwise(
        2 * _upper_tail(F.abs(F.try_divide(F.col("runs") - expected, spread)))
    )
    z_serial = (F.try_divide(F.col("covariance"), F.col("variance")) + 1 / n) * F.sqrt(n)
    p_serial = F.when(F.col("variance") == 0, 0.0).otherwise(2 * _upper_tail(F.abs(z_serial)))
    p = F.least(F.lit(1.0), 3 * F.least(_upper_tail(z_chi), p_runs, p_serial))
    return moments.select(*tokens.columns, F.when(F.col("alphabet").isNotNull(), p).alias("p"))


def thresholds(tested: DataFrame, max_false: float) -> DataFrame:
    """``length_class`` and the lowest bin of p from which on strings are flagged.

    ``tested``: (length_class, bin). At most ``BINS`` x ``LENGTH_CLASSES`` rows are left
    after the first aggregation, whatever the input. Random strings above a bin: their
    density in the upper half times what lies above. The estimated share of others
    among the flagged is at most ``max_false``.
    """
    counts = tested.groupBy("length_class", "bin").agg(F.count("*").alias("n"))
    grid = counts.groupBy("length_class").agg(
        F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins")
    )
    half = BINS // 2
    return grid.select(
        "length_class",
        F.expr(
            f"array_min(filter(sequence({LOWEST}, {half}), b -> "
            "(1 - 2 * aggregate(filter(bins, x -> x.bin >= "
            f"{half}), 0D, (s, x) -> s + x.n) * ({BINS} - b) / {BINS}"
            " / aggregate(filter(bins, x -> x.bin >= b), 1e-9D, (s, x) -> s + x.n))"
            f" <= {max_false}))"
        ).alias("least_bin"),
    ).filter("least_bin IS NOT NULL")


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of spans (merged, sorted), so that all places stay."""
    merged = _merged(spans)
    pieces = F.transform(
        merged,
        lambda s, i: F.concat(
            F.substring(text, _end_before(merged, i) + 1, s["s"] - _end_before(merged, i)),
            F.repeat(F.lit(" "), s["e"] - s["s"]),
        ),
    )
    rest = F.substring(text, F.element_at(merged, -1)["e"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)


def _end_before(merged: Column, i: Column) -> Column:
    return F.when(i == 0, 0).otherwise(F.get(merged, i - 1)["e"])


def _runs(tokens: DataFrame) -> DataFrame:
    """Each candidate whole, cut at slashes, and cut at every mark: (row, run, span).

    A token in a path or beside words fits an encoding only without them; a string that
    uses the marks as digits only whole. ``run`` is where the candidate starts.
    """
    value, start = F.col("span.value"), F.col("span.start")
    cuts = [F.array("span")]
    for pattern in (r"[A-Za-z0-9+_-]{20,}", r"[A-Za-z0-9]{20,}"):
        inner = _spans(value, pattern, "random", lambda x: x.value.rlike("[0-9]"))
        cuts.append(
            F.transform(
                inner,
                lambda s: F.struct(
                    (s.start + start).alias("start"), (s.end + start).alias("end"), s.kind.alias("kind"), s.value.alias("value")
                ),
            )
        )
    every = F.when(value.rlike("[+/_-]"), F.array_distinct(F.concat(*cuts))).otherwise(cuts[0])
    return tokens.select("row", start.alias("run"), F.explode(every).alias("span"))


def _scan(docs: DataFrame, max_false: float, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    """row, doc_id, base and added spans of every input row."""
    text = F.col("text")
    based = (
        whole_text(docs, id_col, text_col)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text",
            *extra,
            _spans(text, ASSIGN, "assign", lambda x: F.length(x.group) >= 8).alias("assign"),
            _spans(text, ACCESS, "access", lambda x: x.length >= 16).alias("access"),
            _spans(text, HEX, "hex").alias("hex"),
        )
        .withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    )
    # what the base finds is cut out; what stands beside it is still tested
    scanned = based.withColumn("blanked", _blanked(text, F.col("base"))).select(
        "row",
        "doc_id",
        *[c for c in based.columns if c not in {"row", "doc_id", "text", "assign", "access", "hex", "base"}],
        "base",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        _spans(F.col("blanked"), CANDIDATE, "random", lambda x: x.value.rlike("[0-9]")).alias("candidates"),
    )
    scanned = materialise(scanned, "secrets")
    tokens = scanned.filter(F.size("candidates") > 0).select(
        "row", F.explode("candidates").alias("span")
    )
    tested = (
        randomness(_runs(tokens).select("row", "run", "span", F.col("span.value").alias("value")))
        .filter("p IS NOT NULL")
        .select(
            "row",
            "run",
            "span",
            F.array_max(
                F.filter(
                    F.array(*[F.lit(c) for c in LENGTH_CLASSES]),
                    lambda c: c <= F.length("span.value"),
                )
            ).alias("length_class"),
            F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin"),
        )
    )
    tested = materialise(tested, "randomness")
    # of a candidate's flagged cuts those stay that lie in no longer one
    before = (
        Window.partitionBy("row", "run")
        .orderBy(F.col("span.start"), F.desc("span.end"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    added = (
        tested.join(F.broadcast(thresholds(tested, max_false)), "length_class")
        .filter("bin >= least_bin")
        .withColumn("_reach", F.max("span.end").over(before))
        .filter("_reach IS NULL OR span.end > _reach")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("added"))
    )
    return scanned.join(added, "row", "left").withColumn(
        "spans",
        F.when(F.col("added").isNull(), F.col("base")).otherwise(
            F.array_sort(F.concat("base", "added"))
        ),
    )


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            # by start, then kind; equal starts of a kind can't be
            F.array_sort(
                F.transform(spans, lambda s: F.struct(s.start.alias("a"), s.kind.alias("k"), s.end.alias("b")))
            ),
            lambda s: F.concat_ws(":", F.element_at(kinds, s.k + 1), s.a, s.b),
        ),
        ",",
    )


def find_secrets(
    docs: DataFrame, max_false: float = 0.1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Secrets of every whole text, one row per input row, by DataFrame functions only.

    ``doc_id``; ``n_assign``, ``n_access``, ``n_hex``: matches of the base patterns;
    ``base_sha256``: digest of their spans; ``spans``: kind:start:end (code points, end
    exclusive) of all spans by start, then kind, comma-joined; ``n_random``: spans that
    the randomness tests add (outside base spans; of a longer string, or of what slashes and
    other marks cut from it). ``max_false`` is the share of other
    strings that may be among the added ones.

    Texts are read once into a narrow written table; only candidates, and at most a few
    hundred counts, are shuffled. Null and empty texts hold nothing; repeated rows are
    reported each; other columns are ignored; an empty table gives an empty result.
    """
    found = _scan(docs, max_false, id_col, text_col)
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_random"),
    )


def redact_secrets(
    docs: DataFrame, max_false: float = 0.1, mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; ``n_chars`` follows, if there.

    All rows and columns stay; rows without a secret are unchanged (null texts too).
    Overlapping spans become one mark. Rows meet their spans by ``doc_id`` and a hash of
    the text, so repeated ids with other texts don't mix. Only rows that match some
    pattern at all are written aside and joined; the others pass without a shuffle.
    """
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    suspect = F.coalesce(
        F.rlike("text", F.lit("|".join(f"(?:{p})" for p in (ACCESS, HEX, CANDIDATE))))
        | F.rlike("text", F.lit(ASSIGN)),
        F.lit(False),
    )
    clash = {"__id", "__text", "__spans"} & set(docs.columns)
    if clash:
        renamed = {c: fresh_name(docs, f"{c}_given") for c in clash}
        cleaned = redact_secrets(docs.withColumnsRenamed(renamed), max_false, mark)
        return cleaned.withColumnsRenamed({new: old for old, new in renamed.items()})
    columns = [f"`{c}`" for c in docs.columns]
    plain, docs = docs.filter(~suspect), materialise(docs.filter(suspect), "suspects")
    found = (
        _scan(docs, max_false, "doc_id", "text", key.alias("__text"))
        .filter(F.size("spans") > 0)
        .select(F.col("doc_id").alias("__id"), "__text", _merged(F.col("spans")).alias("__spans"))
        .dropDuplicates(["__id", "__text"])
    )
    out = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (key == F.col("__text")), "left")
    pieces = F.expr(
        "concat(transform(__spans, (s, i) -> substring(text,"
        " if(i = 0, 0, __spans[i - 1].e) + 1, s.s - if(i = 0, 0, __spans[i - 1].e))),"
        " array(substring(text, element_at(__spans, -1).e + 1)))"
    )
    out = out.withColumn(
        "text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(pieces, mark))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn(
            "n_chars",
            F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(
                F.length("text").cast(docs.schema["n_chars"].dataType)
            ),
        )
    return plain.unionByName(out.select(*columns))


def _merged(spans: Column) -> Column:
    """Spans by start, overlapping ones joined."""
    empty = F.array().cast("array<struct<s:int,e:int>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        fresh = F.struct(x.start.alias("s"), x.end.alias("e"))
        return F.when((F.size(done) == 0) | (last.e <= x.start), F.concat(done, F.array(fresh))).otherwise(
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(last.s.alias("s"), F.greatest(last.e, x.end).alias("e"))),
            )
        )

    return F.aggregate(spans, empty, add)
