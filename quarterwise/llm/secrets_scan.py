"""Secret scans: fixed patterns, and novelty against a primed zstandard compressor.

The patterns give the base spans. The method adds strings in a sensitive context (after a word such
as `key`, `auth` or `password` nearby) that do not compress: a candidate's marginal bytes are what
it adds when it is compressed together with the code around it, by a compressor primed with a
dictionary of the corpus' most frequent identifiers. Names, prose and repeated strings cost few
bytes; random ones cost nearly a byte per character and are reported as `novel`.

Identifiers are counted over all texts; the dictionary holds the most frequent (at most `IDENTIFIERS`) with `LEAST_USES` or more.

Defined results: a null text is empty and has no span. Matches do not overlap within a kind; one
that fails its kind's condition is dropped and not tried again. Novel strings that touch a base span
are not reported twice.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterwise.llm.columns import packed
from quarterwise.llm.shared import cut, frequent
from quarterwise.llm.text import LOWER, slices

IDENTIFIERS = 4096
#: Uses that an identifier of the dictionary has at least.
LEAST_USES = 20
#: Characters before a candidate in which a sensitive word must stand, and code around it that it is compressed with.
NEAR, AROUND = 48, 256
#: Characters of a candidate, and the bytes that each must add.
LEAST_LENGTH, LEAST_NOVELTY = 12, 0.6
#: Bytes that each letter must add where a candidate is letters of one case, apart from a first capital: words of prose that no dictionary has cost up to 0.8.
ONE_CASE_NOVELTY = 0.8
KINDS = ("assign", "access", "hex", "novel")

# The patterns of the base kinds and the words of a sensitive context.
ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SENSITIVE = re.compile(r"(?ai:password|passwd|pwd|secret|token|key|auth|credential|bearer|signature|private)")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")
_SENSITIVE_BYTES = re.compile(rb"pass|pwd|secret|token|key|auth|credential|bearer|signature|private")
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*range(48, 58), *range(97, 103)]] = True


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def novel_spans(text: str, base: list[tuple[int, int, str]], packer: zstandard.ZstdCompressor) -> list[tuple[int, int, str]]:
    found = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        word = m[0]
        if not SENSITIVE.search(text, max(0, a - NEAR), a) or any(x < b and a < y for x, y, _ in base):
            continue
        before, after = text[max(0, a - AROUND) : a], text[b : b + AROUND]
        one_case = word.isalpha() and (word[1:].islower() or word.isupper())
        if novelty(word, before, after, packer) >= (ONE_CASE_NOVELTY if one_case else LEAST_NOVELTY):
            found.append((a, b, "novel"))
    return found


def novelty(word: str, before: str, after: str, packer: zstandard.ZstdCompressor) -> float:
    """Bytes per character that `word` adds to the code around it."""
    size = lambda s: len(packer.compress(s.encode("utf-8", "surrogatepass")))
    return (size(before + word + after) - size(before + after)) / len(word)


def identifiers(texts: DataFrame, most: int = IDENTIFIERS) -> list[str]:
    """The most frequent identifiers of all texts (text), from counts that every task adds up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    held.update(IDENTIFIER.findall(text))
                if len(held) > 500_000:
                    yield out()
                    held.clear()
        yield out()

    counts = texts.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rows = frequent(cut(counts.where(F.col("n") >= LEAST_USES)), most).collect()
    return [r.word for r in sorted(rows, key=lambda r: (-r.n, r.word))]


def primed(words: list[str]) -> bytes:
    """Dictionary content: frequent identifiers last, where matches are cheapest."""
    return " ".join(reversed(words)).encode()


def _flagged(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of texts that may have a span: a sensitive word, an access key or a long run of hex digits in them."""
    raw = LOWER[data].tobytes()
    at = [m.start() for m in _SENSITIVE_BYTES.finditer(raw)]
    spot = raw.find(b"akia")
    while spot >= 0:
        at.append(spot)
        spot = raw.find(b"akia", spot + 1)
    edges = np.diff(np.concatenate([[0], _IS_HEX[data].astype(np.int8), [0]]))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    runs = start[end - start >= LEAST_HEX]
    inner = np.searchsorted(offsets, runs, "right")  # a run over a boundary may be long in the next text
    every = np.concatenate([np.searchsorted(offsets, np.array(at, np.int64), "right") - 1, inner - 1, inner])
    return np.unique(every[(every >= 0) & (every < len(offsets) - 1)])


def spans(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Column `row` with the document's columns (`keep`: only these), and spans: array of (start, end, kind, secret), by start and kind."""
    rows = packed(docs, keep, text=F.col(f"`{text}`").cast("string"))
    shipped = docs.sparkSession.sparkContext.broadcast(primed(identifiers(rows)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("secret", pa.string())]))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, spans array<struct<start: bigint, end: bigint, kind: string, secret: string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shipped.value
        primer = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
        packer = zstandard.ZstdCompressor(level=9, dict_data=primer, write_checksum=False, write_content_size=False)
        for part, data, offsets in slices(batches, "text"):
            out: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for k in _flagged(data, offsets).tolist():
                body = data[offsets[k] : offsets[k + 1]].tobytes().decode()
                base = base_spans(body)
                every = sorted(base + novel_spans(body, base, packer), key=lambda s: (s[0], KINDS.index(s[2])))
                out[k] = [{"start": a, "end": b, "kind": name, "secret": body[a:b]} for a, b, name in every]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, kind)], names=["row", "spans"])

    return rows.mapInArrow(run, schema)
