"""Personal data by bootstrapped contextual extraction.

Matches of strict patterns are the seeds. The words around a seed are lexical
patterns; number-like and address-like strings that the strict patterns don't accept
are instances of the same patterns. Spark scores the graph of patterns and instances
in turn: a pattern is as good as the instances it holds, an instance as good as the
patterns that hold it together. Instances of high-confidence patterns are found data.
"""

from __future__ import annotations

import hashlib
import re
import sys

import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import map_rows, whole_text
from clickloom.operators.joins import lookup_join
from clickloom.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Base kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting only where a run of digits starts changes no match and keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Runs over all groups that blanks part; how many digits there are is checked on the whole.
_NUMBER_LIKE = re.compile(r"(?<![^\s:=#(\[])[0-9(][0-9().-]*(?:\x20[0-9().-]+)*[0-9](?![^\s,.;:!?)\]])")
# Capital letters and digits mixed: account, passport and customer numbers, groups of four as well.
_CODE_LIKE = re.compile(
    r"(?<![^\s:=#(\[])(?=[A-Z]+[0-9]|[0-9]+[A-Z])[A-Z0-9]{4,34}(?:\x20[A-Z0-9]{4}(?![A-Za-z0-9])){0,7}"
    r"(?:\x20[0-9]{1,3})?(?![^\s,.;:!?)\]])"
)
_ADDRESS_LIKE = re.compile(
    r"(?<![^\s:=<(\[])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,64}"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,64}){0,4}"
)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses, found from their @ signs."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at + 1)):
            end = match.end()
            out.append((start, end))
        at = text.find("@", max(end, at + 1))
    return out


def _is_ip(value: str) -> bool:
    parts = [p.lstrip("0") for p in value.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()]
    if not 13 <= len(digits) <= 19:
        return False
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(doubled) + sum(digits[-1::-2])) % 10 == 0


def _is_phone(value: str) -> bool:
    return 9 <= sum(c.isdigit() for c in value) <= 15


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each base kind, in code points. Failing matches are dropped, not retried."""
    spans = {kind: [] for kind in KINDS}
    spans["email"] = emails(text)
    if _DIGIT.search(text):
        for kind, pattern, holds in (
            ("ip", _IP, _is_ip),
            ("card", _CARD, _is_card),
            ("phone", _PHONE, _is_phone),
        ):
            spans[kind] = [m.span() for m in pattern.finditer(text) if holds(m[0])]
    return spans


def lexical_patterns(text: str, start: int, end: int) -> list[str]:
    """The word before a span and the one before that or after it, as patterns."""
    before = [_bare(w) for w in text[max(0, start - 80) : start].split()[-2:]]
    after = [_bare(w) for w in text[end : end + 40].split()[:1]] or [""]
    before = ["", ""][len(before) :] + before
    return [f"{before[0]} {before[1]} _", f"{before[1]} _ {after[0]}"]


def _bare(word: str) -> str:
    return word.strip("\"'.,;:!?()[]<>=").lower()


def candidates(text: str, spans: dict[str, list[tuple[int, int]]]) -> list[dict]:
    """Seeds and number- or address-like strings beside them, with their patterns."""
    taken = sorted((s, e, k) for k in KINDS for s, e in spans[k])
    found = [("email" if k == "email" else "number", True, s, e) for s, e, k in taken]
    free, last = [], 0
    for s, e, _ in taken:
        free.append((last, s))
        last = max(last, e)
    free.append((last, len(text)))
    loose = []
    if _DIGIT.search(text):
        loose += [
            ("number", False, *m.span())
            for m in _NUMBER_LIKE.finditer(text)
            if 7 <= sum(c.isdigit() for c in m[0]) <= 19
        ]
        loose += [
            ("code", False, *m.span())
            for m in _CODE_LIKE.finditer(text)
            if 6 <= sum(c.isalnum() for c in m[0]) <= 34 and sum(c.isdigit() for c in m[0]) >= 4
        ]
    if "@" in text or "(at)" in text or "[at]" in text:
        loose += [("email", False, *m.span()) for m in _ADDRESS_LIKE.finditer(text)]
    k = 0
    for family, seed, s, e in sorted(loose, key=lambda x: (x[2], -x[3])):
        while k < len(free) and free[k][1] < e:
            k += 1
        if k < len(free) and free[k][0] <= s:
            if not found or family != "code" or found[-1][3] <= s:
                found.append((family, seed, s, e))
    return [
        {
            "family": family,
            "seed": seed,
            "start": s,
            "end": e,
            "instance": _hash(family, "".join(text[s:e].split()).lower()),
            # codes have no strict kind of their own: the contexts of numbers find them
            "patterns": [
                _hash("number" if family == "code" else family, p)
                for p in lexical_patterns(text, s, e)
            ],
        }
        for family, seed, s, e in found
    ]


def _hash(family: str, text: str) -> int:
    value = xxhash.xxh64_intdigest(f"{family} {text}".encode())
    return value - (value >> 63 << 64)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_CANDIDATE = pa.struct(
    [
        ("family", pa.string()),
        ("seed", pa.bool_()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("instance", pa.int64()),
        ("patterns", pa.list_(pa.int64())),
    ]
)
_SCANNED = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base_sha256", pa.string()), ("base", pa.string()), ("found", pa.list_(_CANDIDATE))]
)
_SCANNED_DDL = (
    "row long, doc_id long, "
    + ", ".join(f"n_{k} long" for k in KINDS)
    + ", base_sha256 string, base string, found array<struct<family: string, seed: boolean,"
    " start: long, end: long, instance: long, patterns: array<long>>>"
)


def _scan(incoming):
    row_number = TaskContext.get().partitionId() << 40
    for row in incoming:
        text = row["text"]
        spans = base_spans(text)
        base = digest([(k, s, e) for k in KINDS for s, e in spans[k]])
        yield {
            "row": row_number,
            "doc_id": row["doc_id"],
            **{f"n_{k}": len(spans[k]) for k in KINDS},
            "base_sha256": hashlib.sha256(base.encode()).hexdigest(),
            "base": base,
            "found": candidates(text, spans),
        }
        row_number += 1


def confident_instances(
    seen: DataFrame, rounds: int, min_confidence: float, min_seeds: int
) -> DataFrame:
    """Instances other than seeds whose patterns make them personal data.

    ``seen``: (pattern, instance, seed), repeats allowed. In every round a pattern counts
    that holds at least ``min_seeds`` different instances that are seeds or have reached
    ``min_confidence``; so what one pattern finds induces the next. Its score is the mean
    confidence of its instances with one doubtful instance added. An instance's confidence
    is 1 for a seed, else the chance that at least one of its patterns that count is right.

    Edges are distinct pairs. A pattern that very many instances share is combined per
    task before it is shuffled, and salted where instances look its score up.
    """
    edges = materialise(
        seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pattern_edges"
    )
    none = F.lit(None).cast("double")
    known = materialise(
        edges.where("seed").select("instance", F.lit(1.0).alias("confidence")).distinct(), "instances"
    )
    for _ in range(rounds):
        trusted = lookup_join(edges, known, ["instance"], "left")
        scores = (
            trusted.groupBy("pattern")
            .agg(
                (F.sum(F.coalesce("confidence", F.lit(0.0))) / (F.count("*") + 1)).alias("score"),
                F.count_if(F.col("confidence") >= min_confidence).alias("support"),
            )
            .where(F.col("support") >= min_seeds)
            .select("pattern", "score")
        )
        doubt = F.sum(F.log(1 - F.least("score", F.lit(0.999))))
        judged = lookup_join(edges, scores, ["pattern"]).groupBy("instance").agg(
            F.max("seed").alias("seed"), (1 - F.exp(doubt)).alias("found")
        )
        seeds = edges.where("seed").select("instance", F.lit(True).alias("seed"), none.alias("found"))
        known = materialise(
            judged.unionByName(seeds)
            .groupBy("instance")
            .agg(F.max(F.when(F.col("seed"), 1.0).otherwise(F.col("found"))).alias("confidence")),
            "instances",
        )
    found = known.where(F.col("confidence") >= min_confidence)
    return found.join(edges.where("seed").select("instance").distinct(), "instance", "left_anti")


def find_personal_data(
    docs: DataFrame,
    rounds: int = 4,
    min_confidence: float = 0.8,
    min_seeds: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Personal data in every whole text, one row per input row.

    ``doc_id``; ``n_email``, ``n_ip``, ``n_card``, ``n_phone``: base matches;
    ``base_sha256``: digest of the base spans; ``spans``: kind:start:end (code points,
    end exclusive), comma-joined: base kinds as listed, then the ``found_code``,
    ``found_email`` and ``found_number`` strings of confident patterns, each by start;
    ``n_found``. Numbers are taken over all their groups of digits, 7 to 19 in all.

    Texts are read once; a narrow table of spans and candidates is written, and only
    candidates and scores are shuffled. Null and empty texts hold nothing; repeated rows
    are reported each; a null ``doc_id`` stays null; other columns are ignored; an empty
    table gives an empty result.
    """
    scanned = materialise(
        whole_text(docs, id_col, text_col).mapInArrow(map_rows(_SCANNED, _scan), _SCANNED_DDL),
        "personal_data",
    )
    seen = scanned.filter(F.size("found") > 0).select("row", F.explode("found").alias("f"))
    confident = confident_instances(
        seen.select(
            F.explode("f.patterns").alias("pattern"), F.col("f.instance").alias("instance"), "f.seed"
        ),
        rounds,
        min_confidence,
        min_seeds,
    )
    spans = seen.filter(~F.col("f.seed")).select(
        "row", F.col("f.instance").alias("instance"), "f.family", "f.start", "f.end"
    )
    found = (
        lookup_join(spans, confident, ["instance"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("family", "start", "end"))).alias("extra"))
    )
    text = F.array_join(
        F.transform(
            "extra", lambda x: F.concat_ws(":", F.concat(F.lit("found_"), x.family), x.start, x.end)
        ),
        ",",
    )
    base = F.when(F.col("base") != "", F.col("base"))
    return scanned.join(found, "row", "left").select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        "base_sha256",
        F.concat_ws(",", base, text).alias("spans"),
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_found"),
    )
