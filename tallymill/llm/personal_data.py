"""Personal data by patterns, and by contexts bootstrapped from what the patterns find (operator 2)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.tables import discard, stored

# The kinds in order and their forms. The quantifiers give nothing back where that cannot matter, so
# that a match takes time in proportion to its length.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

# Identifier-like words: with a digit or an at sign. They tell what a context is usually about.
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGN = re.compile(r"[0-9@]")
_SPACE = " \t\n\v\f\r"
_EDGES = ".,;:!?()[]{}<>\"'|"
# Forms of unseen identifiers. Addresses with an at sign in some guise, and whole numbers with the signs within.
_AT = re.compile(r" ?(?:@|[(\[{] ?at ?[)\]}]) ?")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?)[A-Za-z0-9-]++)*+")
_NUMBER = re.compile(r"[0-9](?:[ ().:/-]{0,2}[0-9])++")
_GROUPS = re.compile(r"[0-9]+")
FORM_DIGITS = {"card": (13, 19), "phone": (7, 15)}

ROUNDS = 8
LEAST_SEEDS = 3
CONFIDENCE = 0.8
# Instances that a context is imagined to have had before, none of them personal; and how much an unseen identifier with
# the form of a kind counts against the context's being of the kind, as long as it is not known.
DOUBT = 0.5
UNKNOWN = 0.25

Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches: from each at sign back over the local part, no further than the match before."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        else:
            # What stands before this sign cannot be part of a later local part.
            done = at + 1
        at = text.find("@", done)
    return found


def _digits(text: str) -> str:
    return "".join(char for char in text if "0" <= char <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of all base matches, by kind and start."""
    spans = [(0, *span) for span in emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            spans.append((1, *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= CARD_DIGITS[0]:
            digits = _digits(match[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and _luhn(digits):
                spans.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(match[0])) <= PHONE_DIGITS[1]:
                spans.append((3, *match.span()))
    return spans


def _before(text: str, at: int) -> tuple[int, int]:
    """The word that ends before a place, or starts left of it: an empty span if there is none."""
    while at > 0 and text[at - 1] in _SPACE:
        at -= 1
    end = at
    while at > 0 and text[at - 1] not in _SPACE:
        at -= 1
    return at, end


def contexts(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around a span: the two words before it, and one before and one behind it."""
    last = _before(text, start)
    first = _before(text, last[0])
    behind = _WORD.search(text, end)
    found, bare = [], lambda span: text[slice(*span)].lower().strip(_EDGES)
    if first[0] < first[1]:
        found.append(f"{bare(first)} {bare(last)} _")
    if last[0] < last[1] and behind:
        found.append(f"{bare(last)} _ {bare(behind.span())}")
    return [xxhash.xxh64_intdigest(pattern) - (1 << 63) for pattern in found]


def forms(text: str) -> list[tuple[int, int, int]]:
    """``(kinds, start, end)`` of what has the form of some kinds, as bits, without being a base match: in order."""
    found, done = [], 0
    for sign in _AT.finditer(text):
        start = sign.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, sign.end()) if start < sign.start() else None
        if host:
            done = host.end()
            found.append((1 << KINDS.index("email"), start, done))
    for match in _NUMBER.finditer(text):
        groups = _GROUPS.findall(match[0])
        digits, kinds = sum(map(len, groups)), 0
        apart = len(match[0]) - digits == len(groups) - 1 and " " not in match[0]
        if len(groups) == 4 and apart and all(len(part) <= 3 and int(part) <= 255 for part in groups):
            kinds |= 1 << KINDS.index("ip")
        for kind, (least, most) in FORM_DIGITS.items():
            if least <= digits <= most:
                kinds |= 1 << KINDS.index(kind)
        if kinds:
            start = match.start() - (match.start() > 0 and text[match.start() - 1] in "+(")
            found.append((kinds, start, match.end()))
    return sorted(found, key=lambda form: form[1])


def candidates(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """``(kinds, start, end)``: spans with the form of a kind, and identifier-like words of no form (kinds 0), that touch neither a
    base span nor one another."""
    spans = sorted((start, end) for _, start, end in taken)
    kept, at, done = [], 0, 0
    for kinds, start, end in forms(text):
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if start >= done and not (at < len(spans) and spans[at][0] < end):
            kept.append((kinds, start, end))
            done = end
    yield from kept
    spans = sorted([*spans, *((start, end) for _, start, end in kept)])
    at = done = 0
    for sign in _SIGN.finditer(text):
        start = sign.start()
        if start < done:
            continue
        while start > done and text[start - 1] not in _SPACE:
            start -= 1
        end = done = _WORD.match(text, sign.start()).end()
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if not (at < len(spans) and spans[at][0] < end):
            yield 0, start, end


_SPAN = "array<struct<kind:int,start:int,end:int>>"
_MENTION = "array<struct<kind:int,forms:int,start:int,end:int,instance:bigint,patterns:array<bigint>>>"


def _scanned(batches):
    base_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    mention_type = pa.list_(
        pa.struct(
            [
                ("kind", pa.int32()),
                ("forms", pa.int32()),
                ("start", pa.int32()),
                ("end", pa.int32()),
                ("instance", pa.int64()),
                ("patterns", pa.list_(pa.int64())),
            ]
        )
    )
    for batch in batches:
        bases, mentions = [], []
        for text in batch["text"].to_pylist():
            text = text or ""
            base = base_spans(text)
            loose = [(-1, kinds, start, end) for kinds, start, end in candidates(text, base)]
            bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            mentions.append(
                [
                    {
                        "kind": k,
                        "forms": f,
                        "start": s,
                        "end": e,
                        "instance": xxhash.xxh64_intdigest(text[s:e].lower()) - (1 << 63),
                        "patterns": contexts(text, s, e),
                    }
                    for k, f, s, e in [(k, 0, s, e) for k, s, e in base] + loose
                ]
            )
        yield pa.record_batch(
            [batch["doc_id"], batch["copy"], pa.array(bases, base_type), pa.array(mentions, mention_type)],
            ["doc_id", "copy", "base", "mentions"],
        )


def _has(kind: str) -> Column:
    return F.expr(f"forms & shiftleft(1, {kind}) <> 0")


def _trusted_patterns(mentions: DataFrame) -> DataFrame:
    """``pattern, kind, score`` of the contexts that are trusted, bootstrapped from the base matches.

    The graph has a weighted edge for each pattern and instance. Known instances are the seeds, that is what a base pattern
    matched, and from the second round on all that trusted patterns discovered. In every round a pattern's score for
    a kind is the share of its instances that are known to be of the kind, with ``DOUBT`` more that are not, and those that
    are unknown but have its form counting as ``UNKNOWN``; it is trusted from ``CONFIDENCE`` and ``LEAST_SEEDS`` different known instances on. What stands in a trusted pattern and has the form of its
    kind is discovered. So patterns are reached that no seed stands in. The rounds end when no more patterns are trusted, after
    ``ROUNDS`` at the latest. All sums are combined before the shuffle; a context as frequent as any is never gathered.
    """
    edges = stored(
        mentions.select("kind", "forms", "instance", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.max("kind").alias("seed"), F.max("forms").alias("forms"), F.count("*").cast("double").alias("weight")),
        "edges",
    )
    # No pattern is trusted with fewer instances that may become known; the others are left out of the graph's walk.
    able = F.count_if((F.col("seed") >= 0) | (F.col("forms") > 0))
    totals = edges.groupBy("pattern").agg(able.alias("able"), F.sum("weight").alias("total")).where(F.col("able") >= LEAST_SEEDS)
    walk = stored(edges.join(totals, "pattern").drop("able"), "walk")
    discard(edges)
    seeds = walk.where("seed >= 0").select("pattern", "total", "weight", F.col("seed").alias("kind"), F.lit(0.0).alias("found"))
    open_ = walk.where("seed < 0 AND forms > 0")
    every = F.explode(F.array(*[F.lit(kind) for kind in range(len(KINDS))])).alias("kind")
    fitting = open_.select("pattern", "forms", "weight", every).where(_has("kind"))
    fitting = stored(fitting.groupBy("pattern", "kind").agg(F.sum("weight").alias("fitting")), "fitting")
    trusted, before = None, -1
    for _ in range(ROUNDS):
        known = seeds
        if trusted is not None:
            score = F.max(F.struct("score", (-F.col("kind")).alias("kind")))
            discovered = open_.join(trusted, "pattern").where(_has("kind")).groupBy("instance").agg((-score["kind"]).alias("kind"))
            more = open_.join(discovered, "instance").select("pattern", "total", "weight", "kind", F.col("weight").alias("found"))
            known = seeds.unionByName(more)
        sums = known.groupBy("pattern", "kind").agg(
            F.sum("weight").alias("known"), F.sum("found").alias("found"), F.max("total").alias("total"), F.count("*").alias("instances")
        )
        unknown = F.coalesce("fitting", F.lit(0.0)) - F.col("found")
        score = F.col("known") / (F.col("total") - (1 - UNKNOWN) * unknown + DOUBT)
        scored = sums.join(fitting, ["pattern", "kind"], "left").withColumn("score", score)
        following = scored.where((F.col("score") >= CONFIDENCE) & (F.col("instances") >= LEAST_SEEDS))
        following = stored(following.select("pattern", "kind", "score"), "trusted")
        if trusted is not None:
            discard(trusted)
        trusted, size = following, following.count()
        if size <= before or not size:
            break
        before = size
    return trusted


def found_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, base, added``: spans ``kind, start, end`` (code points, end exclusive) of each document's whole text.

    Base spans come from the fixed forms, leftmost and not overlapping within a kind, a match that fails its
    test being dropped. They are seeds: the words around them are patterns, in which further identifiers are discovered, whose
    contexts are patterns again (:func:`_trusted_patterns`). Discovered are addresses with an at sign in some guise and whole numbers
    with the signs in them, if they have the form of the pattern's kind: digits of a card or telephone number that
    the base forms miss, four groups of an ip with other separators. Of several kinds the one of the highest score counts, then the
    first. Added spans touch no base span.

    Null text is empty. Each row of ``documents`` gives one row; rows that repeat id and text get the same spans. Texts are read
    once; only spans are shuffled.
    """
    scanned = stored(
        documents.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("copy"), "text").mapInArrow(
            _scanned, f"doc_id bigint, copy bigint, base {_SPAN}, mentions {_MENTION}"
        ),
        "scanned",
    )
    mentions = scanned.select("doc_id", "copy", F.explode("mentions").alias("m")).select("doc_id", "copy", "m.*")
    patterns = _trusted_patterns(mentions)
    spotted = (
        mentions.where("kind < 0 AND forms > 0")
        .select("doc_id", "copy", "forms", "start", "end", F.explode("patterns").alias("pattern"))
        .join(patterns, "pattern")
        .where(_has("kind"))
        .groupBy("doc_id", "copy", "start", "end")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "kind"))["kind"].alias("kind"))
        .groupBy(F.col("doc_id").alias("d"), F.col("copy").alias("c"))
        .agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("added"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c"))
    joined = scanned.select("doc_id", "copy", "base").join(spotted, same, "left")
    return joined.select("doc_id", "base", F.coalesce("added", F.array().cast(_SPAN)).alias("added"))
