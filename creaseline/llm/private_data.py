"""Personal data by bootstrapped contextual extraction.

Email addresses, IP addresses, card and phone numbers are first found by their form. They
are the seeds. What else looks like an identifier (a chunk with a digit or an at sign, or
several chunks of digits and marks, one blank apart) is a candidate for the kinds whose
checks it passes: digits in number for a phone, also the Luhn sum for a card, four octets
or the longer notation for an IP address, one at sign in some writing for an email address.
A chunk that passes none is known to be of no kind. Seeds and candidates, by their text,
are the instances of a graph whose other side are lexical patterns: the words before and
after a mention, and whether it is of letters or of numbers. Rounds of scoring follow, as grouped
aggregation: a pattern is worth the share of its instances that are known to be of a kind,
shrunk for patterns with few instances, and an unknown instance is worth what its patterns
together make likely. Mentions that a pattern of high confidence covers are added, if they
are candidates for its kind.

Added spans never overlap the spans found by form, nor each other; the latter are kept.

Nulls: null text is empty, and has no spans; a null doc_id is carried along. Repeated rows
are documents of their own, but an instance that repeats, or a copied text, counts once per
pattern. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.sources.workspace import settled

# The kinds in the order of the contract.
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")  # possessive: a long run of digits is read once
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MARKED = re.compile(r"(?:[0-9@]|[(\[{][aA][tT][)\]}])[^\s\"'<>|]*")  # from the first digit or at sign of a chunk on
CHUNK_ENDS = frozenset(" \t\n\r\x0b\x0c\"'<>|")
CHUNK_CHARS = 254  # the longest legal email address; no other kind is longer
LEAST_CHARS = 6
LABEL = re.compile(r"[^\W\d_]{2,}\.?[:=]+(?=[+(]*[0-9]|[^\s:=]*@)")
NUMERIC = re.compile(r"[+(]*[0-9][0-9().+/-]*")
AT_SIGN = re.compile(r"@|[(\[{]at[)\]}]", re.IGNORECASE)
PARTED = re.compile(r"\[\.\]|\(\.\)|[.,-]")  # what may stand between octets
MOST_DIGITS = 19  # of the longest kind, a card number
CONTEXT_CHARS = 40
ROUNDS = 3
PRIOR_INSTANCES = 2.0
CONFIDENT = 0.8
LEAST_INSTANCES = 5


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, mark, at = 0, 0, text.find("@")
    while at >= 0:
        own = text[max(done, mark) : at]
        local = len(own) - len(own.rstrip(LOCAL_PART))
        found = DOMAIN.match(text, at) if local else None
        if found:
            yield at - local, found.end()
            done = found.end()
        mark = at + 1
        at = text.find("@", max(mark, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        start, parts = run.start(), run[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in DIGITS.finditer(text):
        if run.end() - run.start() >= 13:
            digits = run[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for run in DIALLED.finditer(text):
            if 9 <= sum(map(str.isdigit, run[0])) <= 15:
                yield run.span()


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, a, b) for kind in KINDS for a, b in FINDERS[kind](text)]


def form_of(value: str) -> str:
    """Digits as 9, letters as a, runs of either as one."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", value.lower()))


def near_word(piece: str, last: bool) -> str:
    """The word next to a mention, in lower case without marks; digits are masked."""
    words = piece.split()
    if not words:
        return ""
    word = words[-1 if last else 0].lower()
    return re.sub(r"[0-9]+", "9", word.strip(".,;:!?()[]{}\"'*#$%&|"))


def chunks(text: str) -> Iterator[tuple[int, int, int]]:
    """Chunks of up to CHUNK_CHARS with a digit or an at sign: start, end without marks, end."""
    for part in MARKED.finditer(text):
        start, least = part.start(), max(0, part.start() - CHUNK_CHARS)
        while start > least and text[start - 1] not in CHUNK_ENDS and not text[start - 1].isspace():
            start -= 1
        if part.end() - start > 2 * CHUNK_CHARS:
            continue
        label = LABEL.match(text, start, part.end())
        if label and not long_address(text[start : part.end()]):
            start = label.end()
        value = text[start : part.end()].rstrip(".,;:!?*#$%&")
        while value[-1:] == ")" and value.count(")") > value.count("("):
            value = value[:-1].rstrip(".,;:!?*#$%&")
        end = start + len(value)
        while start < part.start() and (text[start] in "[{*#" or text[start] == "(" and ")" not in text[start:end]):
            start += 1
        if text[start:end][:1] == "(" and text[end - 1] == ")" and not NUMERIC.fullmatch(text, start, end):
            start, end = start + 1, end - 1
        if start < end <= start + CHUNK_CHARS:
            yield start, end, part.end()


def long_address(value: str) -> bool:
    """It is an IP address in the notation with colons."""
    if value.count(":") < 2:
        return False
    try:
        return bool(ipaddress.IPv6Address(value))
    except ValueError:
        return False


def possible_kinds(value: str) -> list[str]:
    """Kinds whose checks a text passes that the base expressions have not found."""
    octets = PARTED.split(value)
    four = len(octets) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 for p in octets)
    kinds = ["ip"] if four and all(int(p) <= 255 for p in octets) or long_address(value) else []
    if not (four and value.count(".") == 3) and all(p.isascii() and NUMERIC.fullmatch(p) for p in value.split(" ")):
        digits = "".join(filter(str.isdigit, value))
        if 13 <= len(digits) <= 19 and "+" not in value and luhn(digits):
            kinds.append("card")
        if 7 <= len(digits) <= 15 and "+" not in value[1:].lstrip("+("):
            kinds.append("phone")
    sides = AT_SIGN.split(value)
    if len(sides) == 2 and all(any(map(str.isalnum, side)) for side in sides):
        kinds.append("email")
    return kinds


def numbers(text: str, pieces: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[str]]]:
    """Of chunks of digits one blank apart, as many together as can be of a kind, from the left."""
    at = 0
    while at < len(pieces):
        a, most, digits = pieces[at][0], at, 0
        for k in range(at, len(pieces)):  # each but the first has two digits at least, which bounds it
            own = sum(map(str.isdigit, text[pieces[k][0] : pieces[k][1]]))
            digits += own
            if k > at and (own < 2 or digits > MOST_DIGITS or pieces[k][1] - a > CHUNK_CHARS):
                break
            most = k
        for k in range(most, at - 1, -1):
            kinds = possible_kinds(text[a : pieces[k][1]])
            if kinds:
                break
        yield a, pieces[k][1], kinds
        at = k + 1


def candidates(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, list[str]]]:
    """What overlaps no seed, with the kinds that it can be of."""
    at, pieces, behind = 0, [], -1
    for a, b, whole in chunks(text):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        free = at >= len(taken) or taken[at][0] >= b
        digits = free and NUMERIC.fullmatch(text, a, b)
        if pieces and not (digits and a == behind + 1 and text[behind] == " "):
            yield from numbers(text, pieces)
            pieces = []
        if digits:
            pieces.append((a, b))
            behind = b if b == whole else -2
        elif free:
            yield a, b, possible_kinds(text[a:b])
    yield from numbers(text, pieces)


def mentions(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Seeds, candidates (no kind, but kinds) and what can be of no kind ("none") with their contexts."""
    taken = sorted((a, b, kind) for kind, a, b in spans)
    found = [(a, b, kind, None) for a, b, kind in taken]
    for a, b, kinds in candidates(text, taken):
        if b - a >= LEAST_CHARS:
            found.append((a, b, None if kinds else "none", ",".join(kinds) or None))
    out = []
    for a, b, kind, kinds in found:
        before, after = text[max(0, a - CONTEXT_CHARS) : a], text[b : b + CONTEXT_CHARS]
        left, right = near_word(before, True), near_word(after, False)
        out.append({"start": a, "end": b, "kind": kind, "kinds": kinds, "value": text[a:b].lower()[:CHUNK_CHARS], "form": form_of(text[a:b])[:CHUNK_CHARS], "left": left, "right": right})
    return out


TEXTS = ("kind", "kinds", "value", "form", "left", "right")
MENTION = pa.struct([("start", pa.int64()), ("end", pa.int64()), *((c, pa.string()) for c in TEXTS)])
MENTION_DDL = f"struct<start:long,end:long,{','.join(f'{c}:string' for c in TEXTS)}>"


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, base, digests, found = {k: [] for k in KINDS}, [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            spans = base_spans(text)
            for kind in KINDS:
                counts[kind].append(sum(s[0] == kind for s in spans))
            base.append(joined(spans))
            digests.append(hashlib.sha256(base[-1].encode()).hexdigest())
            found.append(mentions(text, spans))
        columns = [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(base), pa.array(digests), pa.array(found, pa.list_(MENTION))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "mentions"])


def pattern_edges(mentioned: DataFrame) -> DataFrame:
    """pattern, value, kind (null for candidates), kinds: distinct edges of the graph.

    Candidates without kinds may be of every kind. A pattern has a word at least.
    """
    if "kinds" not in mentioned.columns:
        mentioned = mentioned.withColumn("kinds", F.lit(None).cast("string"))
    around = [("b", "left", None), ("a", None, "right"), ("ba", "left", "right")]
    letters = F.when(F.col("form").rlike(r"\p{L}") & ~F.col("form").rlike(":.*:"), "a").otherwise("9")  # long addresses are numbers
    text = lambda tag, words: F.when(F.concat(*words) != "", F.concat_ws("\u0001", F.lit(tag), letters, *words))
    patterns = F.array_compact(F.array(*(text(tag, [c for c in (l, r) if c]) for tag, l, r in around)))
    return mentioned.withColumn("pattern", F.explode(patterns))


def may_be(kind: str):
    """A candidate, by its kinds, can be of a kind."""
    return F.col("kinds").isNull() | F.array_contains(F.split("kinds", ","), F.col(kind))


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, confidence of the patterns that may add mentions.

    An instance is known as far as the best pattern round has made it likely; seeds are
    known for certain, those of no kind too, and candidates start as unknown.
    """
    edges = settled(edges.select("pattern", "value", "kind", "kinds").distinct(), "private-edges")
    likely = None
    for _ in range(rounds):
        if likely is None:
            seen = edges.select("pattern", "value", "kind", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0).alias("belief"))
        else:
            unknown = edges.where("kind is null").drop("kind", "kinds").join(likely, "value", "left")
            unknown = unknown.select("pattern", "value", F.col("likely_kind").alias("kind"), F.coalesce("belief", F.lit(0.0)).alias("belief"))
            known = edges.where("kind is not null").drop("kinds").withColumn("belief", F.lit(1.0))
            seen = known.unionByName(unknown)
        total = seen.groupBy("pattern").agg(F.count("*").alias("instances"))
        mass = seen.where("kind <> 'none'").groupBy("pattern", "kind").agg(F.sum("belief").alias("mass"))
        confidence = F.col("mass") / (F.col("instances") + PRIOR_INSTANCES)
        patterns = mass.join(total, "pattern").withColumn("confidence", confidence)
        patterns = settled(patterns.where(F.col("mass") >= LEAST_INSTANCES), "private-patterns")
        voted = edges.where("kind is null").select("pattern", "value", "kinds").join(patterns, "pattern").where(may_be("kind"))
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        votes = voted.groupBy("value", "kind").agg((1 - doubt).alias("belief"))
        best = F.max(F.struct("belief", "kind")).alias("best")
        likely = votes.groupBy("value").agg(best).select("value", F.col("best.kind").alias("likely_kind"), F.col("best.belief").alias("belief"))
        likely = settled(likely, "private-instances")
    return patterns.where(F.col("confidence") >= CONFIDENT).select("pattern", F.col("kind").alias("new_kind"), "confidence")


def private_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, {counts}, base string, base_sha256 string, mentions array<{MENTION_DDL}>")
    found = settled(found.withColumn("row", F.monotonically_increasing_id()), "private-scan")
    mentioned = pattern_edges(found.select("row", F.explode("mentions").alias("m")).select("row", "m.*"))
    patterns = confident_patterns(mentioned)
    hits = mentioned.where("kind is null").join(patterns, "pattern").where(may_be("new_kind"))
    best = F.max(F.struct("confidence", "new_kind")).alias("best")
    hits = hits.groupBy("row", "start", "end").agg(best)
    added = hits.groupBy("row").agg(F.collect_list(F.struct(F.col("best.new_kind").alias("kind"), "start", "end")).alias("new"))
    old = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(F.split(s, ":")[0].alias("kind"), F.split(s, ":")[1].cast("long").alias("start"), F.split(s, ":")[2].cast("long").alias("end")),
    )
    order = lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    every = F.array_sort(F.transform(F.concat(old, F.coalesce("new", F.array().cast("array<struct<kind:string,start:long,end:long>>"))), order))
    text = F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    table = found.drop("mentions").join(added, "row", "left")
    return table.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", text.alias("spans"), F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("added"))
