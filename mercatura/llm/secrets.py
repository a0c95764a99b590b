"""Secret scan: fixed patterns, and random strings found by their token efficiency.

Ordinary strings are cheap under a BPE vocabulary: its tokens are frequent pieces of text.
Random strings are not, so few characters per token expose them. Known digests (hex of a
hash's length, checksum prefixes), UUIDs and strings without a letter are left out first; a
number between separators counts as one token, and words in capitals between separators
are read in small letters. Every text is settled in its own row.

Defined results: a null or empty text has no spans. Positions are code points of the whole
text, ends exclusive. Fixed patterns are always reported; a random string is reported
where it touches none of their spans. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.llm.bpe import WORDS

KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

MOST_PER_TOKEN = 2.0
"""Characters per token below which a candidate counts as random."""

# Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_CHECKSUM = re.compile(r"(?:md5|sha1|sha224|sha256|sha384|sha512)[-_=].*", re.IGNORECASE)
_UUID = re.compile(r"[0-9a-f]{8}-?(?:[0-9a-f]{4}-?){3}[0-9a-f]{12}", re.IGNORECASE)
_NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9]+(?![A-Za-z0-9])")
_CAPITALS = re.compile(r"[A-Z]+(?:[_-]+(?:[A-Z]+|[0-9]+))+")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoding(content: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in content.splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        "secrets", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}
    )


def known(string: str) -> bool:
    """Whether the string is a digest, a UUID, or numbers and separators."""
    if _HEX_ONLY.fullmatch(string) and len(string) in DIGEST_LENGTHS:
        return True
    if _CHECKSUM.fullmatch(string) or _UUID.fullmatch(string):
        return True
    return not any(c.isalpha() for c in string)


def n_tokens(string: str, encoding: tiktoken.Encoding) -> int:
    """Tokens of the string, numbers between separators being one each."""
    if _CAPITALS.fullmatch(string):
        string = string.lower()
    return len(encoding.encode_ordinary(_NUMBER.sub("1", string)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(
    text: str, encoding: tiktoken.Encoding, taken: list[tuple[int, int, int]], most: float
) -> list[tuple[int, int, int]]:
    """Candidates that touch no span of ``taken`` and have less than ``most`` characters per token."""
    found = []
    at = 0
    furthest = -1  # end of the spans that start before the candidate's end
    for match in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] < match.end():
            furthest = max(furthest, taken[at][2])
            at += 1
        if furthest > match.start() or known(match[0]):
            continue
        if len(match[0]) < most * n_tokens(match[0], encoding):
            found.append((match.start(), 3, match.end()))
    return found


def scan(docs: DataFrame, path: str | None = None, most_per_token: float = MOST_PER_TOKEN) -> DataFrame:
    """Per row of ``docs``: doc_id, spans as an array of (start_at, end_at, kind), in order of
    start, then of ``KINDS``. ``path`` names the rank file, about 0.8 MB, which is broadcast."""
    with open(path or vocabulary_path(), "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    span = pa.struct([("start_at", pa.int64()), ("end_at", pa.int64()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(content.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                spans = sorted(spans + random_spans(text or "", encoding, spans, most_per_token))
                rows.append([{"start_at": s, "end_at": e, "kind": KINDS[k]} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(span))], ["doc_id", "spans"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, spans array<struct<start_at:bigint,end_at:bigint,kind:string>>"
    )


def summary(scanned: DataFrame) -> DataFrame:
    """One row per document: counts of the fixed kinds, digest of their spans, all spans."""

    def listed(spans: Column) -> Column:
        named = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start_at"], s["end_at"]))
        return F.array_join(named, ",")

    def count(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scanned.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
