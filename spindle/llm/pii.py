r"""Personal data: fixed patterns, and bootstrapped contextual extraction of further identifiers.

Base spans (leftmost, non-overlapping per kind): email, ip, card, phone.  A fifth kind,
``secret``, has seeds of its own: quoted values of ``SECRET_CHARS`` or more with a digit and
a letter that a text assigns to a secret's name (``token = "..."``), and keys of well-known
shapes.  They are listed with the spans, after the base kinds, and are no part of the base.

Bootstrapping.  Every run of identifier-like tokens (with an ASCII digit or ``@``) that
single blanks join and no seed touches is a candidate, of any length; a run ends at
other punctuation between its tokens.  Base spans and secrets are the seeds.  Both come with up to
three lexical patterns: the word to the left, the two words to the left, the word to the
right (lower-cased, outer punctuation stripped; words with digits are passed over, so a
run has the patterns of its tokens).  Spark joins patterns and distinct instances into a
graph and scores it round by round, per kind:

* a pattern's confidence is the summed confidence of its distinct instances, divided by
  one more than their number; seeds count 1 for their kind, candidates their own score;
  patterns with fewer than ``MIN_SEEDS`` distinct seeds of a kind get no score;
* an instance's confidence is 1 - prod(1 - confidence) over its patterns' best;
* instances that reach ``ACCEPT`` are seeds of new patterns in the next round.

There are ``ROUNDS`` rounds, and further ones while they accept more instances.
Candidate places whose instance and one of whose patterns reach ``ACCEPT`` become
spans of the kind.  Texts are read once; the graph is made of distinct values, so a
passage copied a million times counts once.

Defined cases: null text counts as empty and has no spans; a key of a known shape inside an
assigned value belongs to the value; an assignment without a digit or without a letter is no seed; spans of one kind that start
together are listed once; repeated rows are handled row by row; an empty table gives an
empty result; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import body, keep

# The patterns of the base kinds, in their order.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SECRET = "secret"
SECRET_CHARS = 16
# Names that secrets are assigned to, and the shapes of well-known keys.
SECRET_NAMES = ("token", "secret", "password", "passwd", "apikey", "api_key", "api-key", "access_key", "access-key",
                "private_key", "private-key", "credential", "credentials")
KEY_SHAPES = (r"AKIA[0-9A-Z]{16}", r"AIza[0-9A-Za-z_-]{35}", r"gh[opsu]_[0-9A-Za-z]{36}", r"xox[abp]-[0-9A-Za-z-]{10,}")
KEY_STARTS = ("AKIA", "AIza", "gho_", "ghp_", "ghs_", "ghu_", "xoxa", "xoxb", "xoxp")
ASSIGNED = re.compile(r"[:=]\s{0,8}([\"'])([^\s\"']{%d,})\1" % SECRET_CHARS)
SHAPED = re.compile(r"(?<![0-9A-Za-z_-])(?:%s)(?![0-9A-Za-z_-])" % "|".join(KEY_SHAPES))
ORDER = (*KINDS, SECRET)

TOKEN = re.compile(r"\S+")
LIKELY = re.compile(r"[0-9@]")
OUTER = " \t\r\n.,;:!?\"'()[]{}<>|=*#$%&"

BLANKS = " \t\u00a0"
PAIRS = dict(zip("([{", ")]}", strict=True))

ROUNDS, MIN_SEEDS, ACCEPT = 3, 3, 0.9
KEY_CHARS = 64

Span = tuple[str, int, int]
Span2 = tuple[int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: every match holds one ``@``, so only the places around them are looked at."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind as listed, then start; code points, end exclusive."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    if LIKELY.search(text):
        spans += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return spans


def secret_spans(text: str) -> list[Span]:
    """Seeds of the kind ``secret``, by start, non-overlapping."""
    spots = set()
    for m in ASSIGNED.finditer(text):
        name = text[max(0, m.start() - 40):m.start()].rstrip().rstrip("\"'").lower()
        value = m.group(2)
        if name.endswith(SECRET_NAMES) and any(map(str.isdigit, value)) and any(map(str.isalpha, value)):
            spots.add(m.span(2))
    if any(start in text for start in KEY_STARTS):
        spots.update(m.span() for m in SHAPED.finditer(text))
    taken, spans = -1, []
    for start, end in sorted(spots, key=lambda s: (s[0], -s[1])):
        if start >= taken:
            spans.append((SECRET, start, end))
            taken = end
    return spans


def _word(token: str) -> str:
    return token.strip(OUTER).lower()


def _context(text: str, start: int, end: int) -> list[str]:
    """Patterns around a place: one and two words to the left, one word to the right."""
    before = [w for w in map(_word, text[max(0, start - 200):start].split()[-4:]) if w and not LIKELY.search(w)][-2:]
    after = [w for w in map(_word, text[end:end + 100].split()[:2]) if w and not LIKELY.search(w)][:1]
    return [" ".join(before[-n:]) + " _" for n in range(1, len(before) + 1)] + [f"_ {w}" for w in after]


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    """The place without outer punctuation, but with the brackets that belong to brackets inside."""
    part = text[start:end]
    a, b = start + len(part) - len(part.lstrip(OUTER)), start + len(part.rstrip(OUTER))
    for opening, closing in PAIRS.items():
        missing = text.count(closing, a, b) - text.count(opening, a, b)
        if missing > 0 and a > start and text[a - 1] == opening:
            a -= 1
        elif missing < 0 and b < end and text[b] == closing:
            b += 1
    return a, b


def _runs(text: str, taken: list[Span2]) -> Iterator[Span2]:
    """Places of the runs of identifier-like tokens, outside the ``taken`` places (by start)."""
    at = n = reach = 0
    run: Span2 | None = None
    for m in LIKELY.finditer(text):
        if m.start() < at:
            continue
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = at = TOKEN.match(text, start).end()
        a, b = _core(text, start, end)
        while n < len(taken) and taken[n][0] < b:
            reach = max(reach, taken[n][1])
            n += 1
        if reach > a:
            if run:
                yield _core(text, *run)
            run = None
        elif run and start == run[1] + 1 and text[run[1]] in BLANKS and _joins(text, run, start):
            run = run[0], end
        else:
            if run:
                yield _core(text, *run)
            run = start, end
    if run:
        yield _core(text, *run)


def _joins(text: str, run: Span2, start: int) -> bool:
    """Whether the token that starts at ``start`` goes on with the run before it."""
    last, first = text[run[1] - 1], text[start]
    return (last not in OUTER or last in ")]}") and (first not in OUTER or first in PAIRS)


def _key(found: str) -> str:
    """The instance's name in the graph: long ones by digest."""
    return found if len(found) <= KEY_CHARS else "sha256:" + hashlib.sha256(found.encode("utf-8", "surrogatepass")).hexdigest()


def sightings(text: str, seeds: list[Span]) -> Iterator[tuple[str | None, str, list[str], int, int]]:
    """(kind or None, instance, patterns, start, end) of seeds and of other identifier-like runs."""
    for kind, start, end in seeds:
        yield kind, _key(text[start:end]), _context(text, start, end), start, end
    for start, end in _runs(text, sorted((start, end) for _, start, end in seeds)):
        yield None, _key(text[start:end]), _context(text, start, end), start, end


def listed(spans: list[Span]) -> str:
    """kind:start:end, by kind as listed, then start, comma-joined."""
    order = sorted(set(spans), key=lambda s: (ORDER.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen_type = pa.list_(pa.struct([("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string())),
                                    ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        lists, more, seen = [], [], []
        for text in batch.column("text").to_pylist():
            base, secrets = base_spans(text), secret_spans(text)
            for k in KINDS:
                counts[k].append(sum(s[0] == k for s in base))
            lists.append(listed(base))
            more.append(listed(secrets))
            seen.append([dict(zip(("kind", "instance", "patterns", "start", "end"), s, strict=True))
                         for s in sightings(text, base + secrets)] if base or secrets or LIKELY.search(text) else [])
        out = [batch.column("row"), batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS),
               pa.array(lists, pa.string()), pa.array(more, pa.string()), pa.array(seen, seen_type)]
        yield pa.RecordBatch.from_arrays(out, names=["row", "doc_id", *(f"n_{k}" for k in KINDS), "base", "secrets", "seen"])


SCANNED = ("row bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, secrets string, "
           "seen array<struct<kind:string,instance:string,patterns:array<string>,start:int,end:int>>")


def scan(documents: DataFrame) -> DataFrame:
    """Base spans, secrets and candidates of every document; written once."""
    named = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                             body().alias("text"))
    return keep(named.mapInArrow(_scan, SCANNED), "pii-scan")


def confidences(scanned: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, accept: float = ACCEPT
                ) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, kind) and instances (instance, kind), after iterative scoring of the graph."""
    seen = scanned.select(F.explode("seen").alias("s")).select("s.kind", "s.instance", "s.patterns")
    graph = keep(seen.select("instance", "kind", F.explode("patterns").alias("pattern")).distinct(), "pii-graph")
    own = graph.filter("kind is not null").select("pattern", "kind", "instance", F.lit(1.0).alias("score"))
    open_edges = graph.filter("kind is null").select("pattern", "instance")
    size = keep(graph.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("size")), "pii-sizes")
    n, accepted, instances = 0, -1, None
    while True:
        scored = own if instances is None else own.unionByName(open_edges.join(instances, "instance"))
        patterns = keep(scored.groupBy("pattern", "kind", "instance").agg(F.max("score").alias("score"))
                        .groupBy("pattern", "kind").agg(F.sum("score").alias("gain"), F.count_if(F.col("score") >= accept).alias("seeds"))
                        .filter(F.col("seeds") >= min_seeds).join(size, "pattern")
                        .select("pattern", "kind", (F.col("gain") / (F.col("size") + 1)).alias("score")), f"pii-patterns-{n}")
        instances = keep(open_edges.join(patterns, "pattern").groupBy("instance", "kind")
                         .agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(1 - 1e-9)))))).alias("score")),
                         f"pii-instances-{n}")
        n, before, accepted = n + 1, accepted, instances.filter(F.col("score") >= accept).count()
        if n >= rounds and accepted == before:
            break
    best = F.max_by("kind", F.struct("score", "kind")).alias("kind")
    return (patterns.filter(F.col("score") >= accept).select("pattern", "kind"),
            instances.groupBy("instance").agg(best, F.max("score").alias("score"))
            .filter(F.col("score") >= accept).select("instance", "kind"))


def find(documents: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, accept: float = ACCEPT) -> DataFrame:
    """Per document: base counts, base list, ``secrets`` list, and ``added`` spans (array of kind, start, end)."""
    scanned = scan(documents)
    patterns, instances = confidences(scanned, rounds, min_seeds, accept)
    places = (scanned.select("row", F.explode("seen").alias("s")).filter("s.kind is null")
              .select("row", "s.instance", "s.start", "s.end", F.explode("s.patterns").alias("pattern")))
    added = (places.join(patterns, "pattern").join(instances, ["instance", "kind"])
             .groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added")))
    return scanned.drop("seen").join(added, "row", "left")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made, digest, found = [], [], []
        for base, more, added in zip(*(batch.column(c).to_pylist() for c in ("base", "secrets", "added")), strict=True):
            spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in f"{base},{more}".split(",") if x)]
            made.append(listed(spans + [(s["kind"], s["start"], s["end"]) for s in added or []]))
            found.append(len(added or []))
            digest.append(hashlib.sha256(base.encode()).hexdigest())
        rest = batch.drop_columns(["base", "secrets", "added"])
        yield (rest.append_column("base_sha256", pa.array(digest, pa.string())).append_column("spans", pa.array(made, pa.string()))
               .append_column("n_added", pa.array(found, pa.int64())))


def document_spans(documents: DataFrame, **options) -> DataFrame:
    """doc_id, base counts, the base list's SHA-256, all spans of every document, and the number of spans from contexts."""
    found = find(documents, **options).select("doc_id", *(f"n_{k}" for k in KINDS), "base", "secrets", "added")
    return found.mapInArrow(_merge, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                    "base_sha256 string, spans string, n_added bigint")
