"""Edit-aware token counts over pre-token segment trees.

A text is cut into segments of whole pre-tokens (a segment begins at white
space that follows other characters, where byte-level pre-tokenizers always
cut). A document's tree keeps, for every node, the characters and tokens below
it. An edit finds its segments by walking down the character sums, re-encodes
only these, widened to the neighbours whose pre-tokens could change across a
segment border, and updates the sums on the way up. Segments that an edit
empties stay as empty leaves, so a tree keeps its shape.

Trees are columns of a table (``build_trees``): the segments, and the sums of
all nodes. A later batch of edits, joined to the stored trees, updates them
(``edit_trees``) without encoding or counting what it does not touch.

Defined results: a null or empty text has one empty segment and no tokens;
edits are (begin, end, replacement) in code points of the text as it is when
they are applied, one after the other, clipped to its ends; null edits change
nothing; repeated rows are counted alike, each on its own; an empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import PieceEncoder, slices
from .byte_bpe import load_ranks
from .common import bind, text_batches, text_or_empty

SEGMENT_CHARS = 192
_W, _N = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"      # white space as pre-tokenizers see it, and the rest
_BORDER = re.compile(rf"(?<={_N}){_W}")
_OPENS = re.compile(_W)
_CLOSES = re.compile(rf"{_W}\Z")

Count = Callable[[list[str]], Sequence[int]]


def segments_of(text: str, chars: int = SEGMENT_CHARS) -> list[str]:
    """Consecutive segments of at least ``chars`` characters, but the last."""
    out, at = [], 0
    while len(text) - at > chars:
        border = _BORDER.search(text, at + chars)
        if border is None:
            break
        out.append(text[at:border.start()])
        at = border.start()
    out.append(text[at:])
    return out


class SegmentTree:
    """Sums of characters and tokens over the segments of one text."""

    def __init__(self, segments: list[str], counts: Sequence[int]):
        self.segments = list(segments)
        n = 1
        while n < len(segments):
            n *= 2
        self.leaves = n
        self.chars = [0] * (2 * n)
        self.tokens = [0] * (2 * n)
        self.chars[n:n + len(segments)] = map(len, segments)
        self.tokens[n:n + len(segments)] = map(int, counts)
        for k in range(n - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
        self.reencoded_segments = self.reencoded_chars = 0

    @classmethod
    def stored(cls, segments: Sequence[str], chars: Sequence[int], tokens: Sequence[int]) -> "SegmentTree":
        """A tree as it was kept, without counting anything."""
        tree = cls.__new__(cls)
        tree.segments, tree.leaves = list(segments), len(chars) // 2
        tree.chars, tree.tokens = [int(c) for c in chars], [int(t) for t in tokens]
        tree.reencoded_segments = tree.reencoded_chars = 0
        return tree

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """The segment that holds character ``at`` and where it begins."""
        k, begin = 1, 0
        while k < self.leaves:
            k *= 2
            if at >= begin + self.chars[k]:
                begin += self.chars[k]
                k += 1
        return min(k - self.leaves, len(self.segments) - 1), begin

    def _set(self, i: int, text: str, tokens: int) -> None:
        self.segments[i] = text
        k = self.leaves + i
        self.chars[k], self.tokens[k] = len(text), tokens
        while k > 1:
            k //= 2
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def edit(self, begin: int, end: int, replacement: str, count: Count) -> None:
        """Replace the characters from ``begin`` up to ``end``."""
        begin = max(0, min(begin, self.n_chars))
        end = max(begin, min(end, self.n_chars))
        if begin == end and not replacement:
            return
        first, at = self.find(max(0, min(begin, self.n_chars - 1)))
        last = first
        if end > begin:
            last = max(first, self.find(end - 1)[0])
        old = "".join(self.segments[first:last + 1])
        if begin - at > len(old):                   # past the end of an emptied leaf
            at = begin - len(old)
        new = old[:begin - at] + replacement + old[end - at:]
        # what stands before must end at a border, and so must the new text
        while first > 0:
            before = self.segments[first - 1]
            if before and not _CLOSES.search(before) and new and _OPENS.match(new):
                break
            first -= 1
            new = before + new
        while last + 1 < len(self.segments):
            after = self.segments[last + 1]
            if after and _OPENS.match(after) and not (new and _CLOSES.search(new)):
                break
            last += 1
            new += after
        self.reencoded_segments += last - first + 1
        self.reencoded_chars += len(new)
        self._set(first, new, int(count([new])[0]))
        for k in range(first + 1, last + 1):
            if self.segments[k]:
                self._set(k, "", 0)

    def text(self) -> str:
        return "".join(self.segments)


def token_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def piece_counter(encoding: tiktoken.Encoding) -> PieceEncoder:
    """Encoder of many texts that keeps the pieces it has seen."""
    return PieceEncoder(lambda pieces: [np.asarray(encoding.encode_ordinary(p), "<u4") for p in pieces])


TREE_COLUMNS = ("segments", "chars", "tokens")
TREE_SCHEMA = "segments array<string>, chars array<bigint>, tokens array<bigint>"
COUNT_SCHEMA = ("n_tokens long, n_tokens_edited long, n_chars long, n_chars_edited long, n_segments long, "
                "segments_reencoded long, chars_reencoded long")


def build_trees(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                edits: Column | None = None) -> DataFrame:
    """A row per document: id, segments, and the characters and tokens below
    every node of its tree (root second, leaves from the middle on); a column
    ``edits`` may come along."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = piece_counter(token_encoding(path, pattern))
        for pdf in batches:
            texts = pdf["text"].tolist()
            for cut in slices(texts):
                parts = [segments_of(t) for t in texts[cut]]
                counts = encoder.encode([s for p in parts for s in p])[1]
                trees, at = [], 0
                for segments in parts:
                    trees.append(SegmentTree(segments, counts[at:at + len(segments)]))
                    at += len(segments)
                out = pdf.iloc[cut].drop(columns="text")
                yield out.assign(segments=[t.segments for t in trees], chars=[t.chars for t in trees],
                                 tokens=[t.tokens for t in trees])

    text_batches(docs.sparkSession)
    carried = [edits.alias("edits")] if edits is not None else []
    rows = docs.select(F.col(id_col).alias("id"), *carried, text_or_empty(F.col(text_col)).alias("text"))
    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInPandas(run, f"{ids}, {TREE_SCHEMA}").withColumnRenamed("id", id_col)


def edit_trees(trees: DataFrame, edits: Column, path: str, pattern: str, id_col: str = "doc_id",
               keep_trees: bool = True) -> DataFrame:
    """The trees after their ``edits`` (an array of (begin, end, replacement);
    null: none), with the token and character counts before and after, and how
    much was encoded again; without the trees themselves if not ``keep_trees``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = token_encoding(path, pattern)
        recount = lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
        names = [c.split()[0] for c in COUNT_SCHEMA.split(", ")]
        for pdf in batches:
            rows, after = [], []
            for segments, chars, tokens, own in zip(pdf["segments"], pdf["chars"], pdf["tokens"], pdf["edits"]):
                tree = SegmentTree.stored(segments, chars, tokens)
                before, n_chars = tree.n_tokens, tree.n_chars
                for e in (own if own is not None else ()):
                    tree.edit(e["begin"], e["end"], e["replacement"], recount)
                rows.append((before, tree.n_tokens, n_chars, tree.n_chars, len(segments),
                             tree.reencoded_segments, tree.reencoded_chars))
                after.append(tree)
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "id", pdf["id"].to_numpy())
            if keep_trees:
                out = out.assign(segments=[t.segments for t in after], chars=[t.chars for t in after],
                                 tokens=[t.tokens for t in after])
            yield out

    text_batches(trees.sparkSession)
    rows = trees.select(F.col(id_col).alias("id"), *TREE_COLUMNS, edits.alias("edits"))
    kind = trees.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {COUNT_SCHEMA}" + (f", {TREE_SCHEMA}" if keep_trees else "")
    return rows.mapInPandas(run, schema).withColumnRenamed("id", id_col)


def count_edited(docs: DataFrame, edits: Column, path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Token counts of every document before and after its ``edits`` (an array
    of (begin, end, replacement)), and how much was encoded again."""
    trees = build_trees(docs, path, pattern, id_col, text_col, edits)
    return edit_trees(trees, F.col("edits"), path, pattern, id_col, keep_trees=False)


def sample_edits(text: Column) -> Column:
    """Three edits of a text made from itself: a quarter in, five code points
    become its first nine; in the middle, seven go; three quarters in, its last
    six code points are put in."""
    def of_text(t: Column) -> Column:
        n = F.char_length(t)
        spot = lambda k: F.floor(n * k / 4).cast("int")
        edit = lambda b, e, r: F.struct(b.alias("begin"), e.alias("end"), r.alias("replacement"))
        return F.array(edit(spot(1), spot(1) + 5, F.substring(t, F.lit(1), F.lit(9))),
                       edit(spot(2), spot(2) + 7, F.lit("")),
                       edit(spot(3), spot(3), F.substring(t, F.greatest(n - 5, F.lit(1)), F.lit(6))))
    return bind(text_or_empty(text), of_text)
