"""Repeated passages: sliding spans of sentences, joined over all documents.

A span is the shortest run of consecutive sentences, two at least, that has a given number of
words, taken from every sentence forwards, and from the last one of every line backwards too. The
first place of a span in the corpus (smallest doc_id, then earliest sentence) stays; the sentences
that any later place covers are removed.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import prepare, text_or_empty, written

SPAN_WORDS = 20
SPAN_SENTENCES = 2
LONG_SENTENCE = 24
# A sentence ends behind its closing marks before white space, or at a line's end. A run of marks is tried
# from its beginning only and never in parts, so the time is linear in the text.
_END = re.compile(r"(?<![.!?…。！？])[.!?…。！？]++[\"'”’)\]]*+(?=\s|$)|\n")
_CLAUSE_EVERY = 8
SPANS = "doc_id bigint, text_hash bigint, h1 bigint, h2 bigint, first int, last int"


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of the sentences; between them they cover the whole text.

    A sentence of more than LONG_SENTENCE words is cut where the content says so, behind words whose
    hash is a multiple of _CLAUSE_EVERY, so that text without full stops still aligns.
    """
    out = []
    for first, last in _bounds(text):
        sentence = text[first:last]
        words = sentence.split()
        if len(words) <= LONG_SENTENCE:
            out.append((first, last, words))
            continue
        start, part = first, []
        for w in re.finditer(r"\S+", sentence):
            part.append(w.group())
            if xxhash.xxh64_intdigest(w.group().encode("utf-8", "surrogatepass")) % _CLAUSE_EVERY == 0:
                out.append((start, first + w.end(), part))
                start, part = first + w.end(), []
        if start < last:
            out.append((start, last, part))
    return out


def _bounds(text: str):
    """(start, end) of sentences and of line feeds, which stand alone."""
    start = 0
    for m in _END.finditer(text):
        end = m.start() if m.group() == "\n" else m.end()
        if end > start:
            yield start, end
        if m.group() == "\n":
            yield m.start(), m.end()
        start = m.end()
    if start < len(text):
        yield start, len(text)


def runs(words: list[list[str]]) -> list[tuple[int, int]]:
    """First and last sentence of every span; sentences without words count for none."""
    full = [i for i, w in enumerate(words) if w]
    sizes = [len(words[i]) for i in full]
    found, end, total = set(), 0, 0
    for i in range(len(full)):
        while end < len(full) and (total < SPAN_WORDS or end - i < SPAN_SENTENCES):
            total, end = total + sizes[end], end + 1
        if total >= SPAN_WORDS and end - i >= SPAN_SENTENCES:
            found.add((full[i], full[end - 1]))
        total -= sizes[i]
    for i, at in enumerate(full):
        if at + 1 < len(words) and words[at + 1]:
            continue
        start, total = i, 0
        while start >= 0 and (total < SPAN_WORDS or i - start < SPAN_SENTENCES):
            total, start = total + sizes[start], start - 1
        if total >= SPAN_WORDS and i - start >= SPAN_SENTENCES:
            found.add((full[start + 1], at))
    return sorted(found)


def _hashes(words: list[list[str]], first: int, last: int) -> tuple[int, int]:
    joined = " ".join(w for s in words[first:last + 1] for w in s).encode("utf-8", "surrogatepass")
    both = xxhash.xxh3_128_intdigest(joined)
    return tuple(v - (1 << 64) if v >> 63 else v for v in (both >> 64, both & ((1 << 64) - 1)))


def document_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, h1, h2, first, last): every span of every document, by sentence number."""
    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(6)]
            for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = [s[2] for s in sentences(text)]
                for first, last in runs(words):
                    for c, v in zip(cols, (doc_id, text_hash, *_hashes(words, first, last), first, last)):
                        c.append(v)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                ["doc_id", "text_hash", "h1", "h2", "first", "last"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, SPANS)


def _cleaned(docs: DataFrame) -> DataFrame:
    kinds = ("doc_id bigint, n_sentences int, n_removed int, removed_words bigint, "
             "removed_spans string, first_doc_ids array<bigint>, text string")

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, covered, firsts in zip(*(c.to_pylist() for c in batch.columns)):
                parts = sentences(text)
                gone = {i for a, b in (covered or []) for i in range(a, b + 1)}
                cut, end = [], -1
                for i in sorted(gone):
                    a, b, _ = parts[i]
                    if a == end:
                        cut[-1][1] = b
                    else:
                        cut.append([a, b])
                    end = b
                kept = "".join(text[a:b] for i, (a, b, _) in enumerate(parts) if i not in gone)
                out.append((doc_id, len(parts), len(gone), sum(len(parts[i][2]) for i in gone),
                            ",".join(f"{a}:{b}" for a, b in cut), sorted(firsts or []), kept))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(),
                     pa.list_(pa.int64()), pa.string()]
            names = [k.split()[0] for k in kinds.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    return docs.mapInArrow(run, kinds)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_sentences, n_removed, removed_words, removed_spans
    (start:end in characters of the text, comma-joined), first_doc_ids (documents that hold the
    passages' first places), text (what is left).

    Spans are compared by their words; white space between them does not matter, case does. Within
    one document a span's later places are removed too. Texts are read whole; a null text is
    empty and stays so. Null ids come before all others, and documents of equal id are ordered by a
    hash of their text; rows that repeat both id and text are one document, and are all cleaned alike.
    An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    spans = written(document_spans(rows), "spans")
    place = F.struct("doc_id", "text_hash", "first").alias("place")
    repeated = written(
        spans.groupBy("h1", "h2").agg(F.min(place).alias("home"), F.count("*").alias("n"))
        .filter("n > 1").select("h1", "h2", "home"), "repeated-spans")
    at_home = F.col("doc_id").eqNullSafe(F.col("home.doc_id")) & (
        F.col("text_hash") == F.col("home.text_hash")) & (F.col("first") == F.col("home.first"))
    covered = spans.join(repeated, ["h1", "h2"]).filter(~at_home).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.array("first", "last")).alias("covered"),
        F.collect_set("home.doc_id").alias("firsts"))
    covered = written(covered, "covered").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = rows.doc_id.eqNullSafe(F.col("_id")) & (rows.text_hash == F.col("_hash"))
    return _cleaned(rows.join(covered, same, "left").select("doc_id", "text", "covered", "firsts"))
