"""Token counts that follow edits.

A document's words, cut where the tokenizer always ends one, are grouped into
leaves, and a tree of sums over the leaves keeps characters and tokens. An edit
is located in the tree by its character place; the leaves it touches, and their
neighbours as far as the edit may move a word's end, are encoded again, and the
sums above them are updated. Everything else keeps its counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgrain.llm.tokenizing import KEPT_CHARS, KEPT_WORDS, CachedTokenizer

#: Words of a new leaf, and of one that has grown so far that it is cut.
LEAF, MOST = 32, 256
EDITS = "array<struct<start:int,end:int,text:string>>"
TREE = [T.StructField("n_tokens", T.LongType()), T.StructField("chars_tree", T.BinaryType()), T.StructField("tokens_tree", T.BinaryType())]
#: A cut: a space after anything but white space begins a word for the tokenizer, whatever follows.
CUT = re.compile(r"(?<=\S)(?= )")


class WordCounter:
    """Tokens of words, kept per worker."""

    def __init__(self, ranks_file: str, added: bool = False) -> None:
        self.encoder = CachedTokenizer.at(ranks_file, added)
        self.known: dict[str, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        known, distinct = self.known, set(words)
        if len(known) + len(distinct) > KEPT_WORDS:
            known.clear()
        # long words, and those of a text of very many, serve this text alone
        few = len(distinct) <= KEPT_WORDS
        once = {}
        for w in distinct:
            if w not in known:
                (known if few and len(w) <= KEPT_CHARS else once)[w] = len(self.encoder.whole(w)) // 4
        return [known[w] if w in known else once[w] for w in words] if once else [known[w] for w in words]


def cut_words(text: str) -> list[str]:
    return CUT.split(text) if text else []


def sums(leaves: np.ndarray) -> np.ndarray:
    """The tree over some leaves as a heap: node k has the children 2k and 2k + 1, the root is 1."""
    width = 1 << max(0, len(leaves) - 1).bit_length()
    heap = np.zeros(2 * width, dtype=np.int32)
    heap[width : width + len(leaves)] = leaves
    level = width
    while level > 1:
        heap[level // 2 : level] = heap[level : 2 * level : 2] + heap[level + 1 : 2 * level : 2]
        level //= 2
    return heap


def built(words: list[str], counter: WordCounter) -> tuple[np.ndarray, np.ndarray]:
    """Leaf sizes in characters and tokens."""
    if not words:
        return np.zeros(1, dtype=np.int32), np.zeros(1, dtype=np.int32)
    at = np.arange(0, len(words), LEAF)
    chars = np.add.reduceat(np.fromiter(map(len, words), dtype=np.int32, count=len(words)), at)
    return chars, np.add.reduceat(np.array(counter.counts(words), dtype=np.int32), at)


class CountedText:
    """A text by leaf, with its trees of characters and tokens."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, counter: WordCounter) -> None:
        self.counter = counter
        self.chars, self.tokens = chars.copy(), tokens.copy()
        self.width = len(chars) // 2
        ends = np.cumsum(self.chars[self.width :])
        self.pieces = [text[end - n : end] for end, n in zip(ends.tolist(), self.chars[self.width :].tolist(), strict=True)]
        self.encoded = 0

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    def leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place``, and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place - begin >= self.chars[node]:
                begin += int(self.chars[node])
                node += 1
        return node - self.width, begin

    def put(self, leaf: int, words: list[str]) -> None:
        """New words of one leaf, and the sums above it."""
        self.pieces[leaf] = "".join(words)
        change = len(self.pieces[leaf]) - int(self.chars[self.width + leaf])
        tokens = sum(self.counter.counts(words)) - int(self.tokens[self.width + leaf])
        self.encoded += len(words)
        node = self.width + leaf
        while node:
            self.chars[node] += change
            self.tokens[node] += tokens
            node //= 2

    def replace(self, start: int, end: int, text: str) -> None:
        """Characters ``start`` to ``end`` of the text as it is now become ``text``; places beyond its end mean its end."""
        start, end = min(max(start, 0), self.n_chars), min(max(start, end), self.n_chars)
        # the cut at a region's beginning holds as long as its first character and the one before do
        first, begin = self.leaf(max(0, min(start - 1, self.n_chars - 1)))
        while first and start <= begin:
            first -= 1
            begin -= len(self.pieces[first])
        last, last_begin = self.leaf(max(0, min(end, self.n_chars - 1)))
        last = max(first, last)
        region = "".join(self.pieces[first : last + 1])
        region = region[: start - begin] + text + region[end - begin :]
        # the cut after it holds if it still ends in anything but white space
        while last + 1 < self.width and (not region or region[-1].isspace() or not self.pieces[last + 1]):
            last += 1
            region += self.pieces[last]
        words = cut_words(region)
        slots = last - first + 1
        if len(words) > MOST * slots:
            self.regrow(first, last, words)
            return
        share = -(-len(words) // slots) or 1
        for k in range(slots):
            self.put(first + k, words[k * share : (k + 1) * share])

    def regrow(self, first: int, last: int, words: list[str]) -> None:
        """More leaves in place of some; the others keep their counts."""
        chars, tokens = built(words, self.counter)
        self.encoded += len(words)
        ends = np.cumsum(chars).tolist()
        whole = "".join(words)
        pieces = [whole[end - n : end] for end, n in zip(ends, chars.tolist(), strict=True)]
        at = slice(self.width + first, self.width + last + 1)
        keep = [np.delete(a[self.width :], np.s_[first : last + 1]) for a in (self.chars, self.tokens)]
        assert self.chars[at].size == last - first + 1
        self.chars = sums(np.insert(keep[0], first, chars))
        self.tokens = sums(np.insert(keep[1], first, tokens))
        self.pieces[first : last + 1] = pieces
        self.width = len(self.chars) // 2
        self.pieces += [""] * (self.width - len(self.pieces))


def with_token_trees(docs: DataFrame, ranks_file: str, text_col: str = "text", added: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``chars_tree`` and ``tokens_tree``; a null text counts as empty."""
    held = docs.drop(*(f.name for f in TREE))
    at = held.columns.index(text_col)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(ranks_file, added)
        for batch in batches:
            totals, chars, tokens = [], [], []
            for text in batch.column(at):
                own_chars, own_tokens = built(cut_words(text.as_py() or ""), counter)
                totals.append(int(own_tokens.sum()))
                chars.append(sums(own_chars).tobytes())
                tokens.append(sums(own_tokens).tobytes())
            new = [pa.array(totals, pa.int64()), pa.array(chars, pa.binary()), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *(f.name for f in TREE)])

    return held.mapInArrow(build, T.StructType([*held.schema.fields, *TREE]))


def recounted(
    counted: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", added: bool = False
) -> DataFrame:
    """Counts after edits, of rows that have their trees.

    ``edits_col`` lists replacements of characters ``start`` to ``end`` by
    ``text`` in the order in which they are made, each in the text that the ones
    before it have left. ``added`` is as it was for the trees. Null edits are none, a null ``text`` deletes. Result:
    ``id_col``, ``n_tokens_before``, ``n_edits``, ``n_tokens``, ``n_words`` and
    ``n_encoded``, the words that had to be encoded again.
    """
    source = counted.select(F.col(id_col), F.col(text_col), "chars_tree", "tokens_tree", F.col(edits_col))
    schema = T.StructType(
        [source.schema[id_col], *(T.StructField(n, T.LongType()) for n in ("n_tokens_before", "n_edits", "n_tokens", "n_words", "n_encoded"))]
    )

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(ranks_file, added)
        for batch in batches:
            rows = []
            for text, chars, tokens, edits in zip(*(batch.column(k) for k in range(1, 5)), strict=True):
                text, edits = text.as_py() or "", edits.as_py() or []
                heaps = [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in (chars, tokens)]
                before = int(heaps[1][1])
                if not edits:
                    rows.append((before, 0, before, len(cut_words(text)), 0))
                    continue
                own = CountedText(text, *heaps, counter)
                for e in edits:
                    own.replace(e["start"], e["end"], e["text"] or "")
                rows.append((before, len(edits), own.n_tokens, sum(len(cut_words(p)) for p in own.pieces), own.encoded))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=schema.names)

    return source.mapInArrow(recount, schema)


def with_edits(counted: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``counted`` with the edits of a table ``id_col``, ``seq``, ``start``, ``end``, ``text``, in order of ``seq``."""
    own = edits.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("seq", F.struct("start", "end", "text").alias("edit")))).alias("_edits"))
    return counted.join(own, id_col, "left").withColumn("edits", F.col("_edits.edit")).drop("_edits")


#: Personal data that is replaced: an address, an IPv4 number, a card number.
REDACTIONS = (
    (re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}"), "<email>"),
    (re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"), "<ip>"),
    (re.compile(r"(?<![0-9])[0-9]{13,16}(?![0-9])"), "<card>"),
)


def redactions(text: str) -> list[dict]:
    """Edits that replace personal data, last place first so that each leaves the others' places as they are."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), REDACTIONS[0][1]) for m in REDACTIONS[0][0].finditer(text)]
    for pattern, name in REDACTIONS[1:]:
        found += [(m.start(), m.end(), name) for m in pattern.finditer(text)]
    edits, before = [], len(text)
    for start, end, name in sorted(found, reverse=True):
        if end <= before:
            edits.append({"start": start, "end": end, "text": name})
            before = start
    return edits


def with_redactions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``edits`` that redact personal data."""
    held = docs.drop("edits")
    at = held.columns.index(text_col)
    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType())]))
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = pa.array([redactions(t.as_py() or "") for t in batch.column(at)], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, edits], names=[*batch.schema.names, "edits"])

    return held.mapInArrow(find, T.StructType([*held.schema.fields, T.StructField("edits", kind)]))


def redacted_counts(docs: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text", added: bool = False) -> DataFrame:
    """Token counts of ``docs`` before and after personal data is redacted, one row per row.

    A null or empty text has no tokens and no edits; ids may be null or repeat;
    other columns are not looked at. With ``added`` the added token of the
    vocabulary is found inside texts and counts as one.
    """
    counted = with_token_trees(docs.select(id_col, text_col), ranks_file, text_col, added)
    return recounted(with_redactions(counted, text_col), ranks_file, id_col, text_col, added=added)
