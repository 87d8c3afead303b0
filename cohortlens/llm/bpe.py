"""Encoding many texts inside a task, each distinct piece once.

A piece is a run of non-white characters with the white space before it. The
byte-level pre-tokenizer never joins characters across the end of such a run
and never looks left, so pieces encode independently; a batch's texts are cut
into pieces, the distinct ones encoded by the library, and the ids gathered.
A text that holds the string of an added token (``<|endoftext|>``) goes to the
library whole, which gives that token's id, as its plain call does.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_PIECES = 250_000       # bound of a worker's piece cache
JOINED = 200                  # pieces encoded in one library call
# Unicode white space as the tokenizers see it: Python's \s without x1c-x1f.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+\Z")
_BARE = "\x1f"                 # marks a word that no space stands before
_SPACE = chr(256 + 32)         # the letter by which byte-level vocabularies write a space


class PieceEncoder:
    """``encode_pieces`` maps a list of strings to a list of id sequences, or to
    all ids in a row and the count of each string.

    Known pieces keep a slot in a table of bounded size, a column of strings
    that a batch's distinct words are looked up in at once; when it is full,
    the slots that were used more than once since the last time stay."""

    def __init__(self, encode_pieces: Callable[[list[str]], list | tuple[np.ndarray, np.ndarray]],
                 added: Sequence[str] = ()):
        self._encode_pieces, self.added = encode_pieces, added      # strings of added tokens, for ``TextEncoder``
        self._reset(pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, "<u4"))

    def _reset(self, slots: pa.Array, sizes: np.ndarray, flat: np.ndarray) -> None:
        self._slots, self._sizes, self._flat = slots, sizes, flat
        self._starts = np.cumsum(sizes) - sizes
        self._uses = np.zeros(len(sizes), np.int64)

    def _find(self, keys: pa.Array) -> np.ndarray:
        """The slot of each key, -1 for unknown ones."""
        return pc.fill_null(pc.index_in(keys, self._slots), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def _add(self, keys: list[str], pieces: list[str]) -> np.ndarray:
        """The slots of new keys, in their order."""
        found, first, uses = self._encode_pieces(pieces), len(self._slots), self._uses
        if not isinstance(found, tuple):
            found = (np.fromiter(chain.from_iterable(found), "<u4"), np.array([len(x) for x in found], np.int64))
        self._reset(pa.concat_arrays([self._slots, pa.array(keys, pa.large_string())]),
                    np.concatenate([self._sizes, found[1]]), np.concatenate([self._flat, found[0]]))
        self._uses[:first] = uses
        return np.arange(first, len(self._slots))

    def _shrink(self) -> None:
        kept = np.flatnonzero(self._uses > 1)
        if len(kept) > CACHED_PIECES // 2:
            kept = np.sort(kept[np.argsort(-self._uses[kept], kind="stable")[:CACHED_PIECES // 2]])
        n = self._sizes[kept]
        self._reset(self._slots.take(pa.array(kept)), n, _runs_of(self._flat, self._starts[kept], n))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (little-endian 32-bit) and the count of each text."""
        if len(self._slots) > CACHED_PIECES:
            self._shrink()
        slow = {k for k, t in enumerate(texts) if _BARE in t}
        fast = [k for k, t in enumerate(texts) if t and k not in slow]
        # split and number the words column-wise; only distinct ones are objects
        marked = pa.array([t[1:] if t[0] == " " else _BARE + t for t in map(texts.__getitem__, fast)],
                          pa.large_string())
        # a pre-token always ends between a letter or digit and these marks
        marked = pc.replace_substring_regex(marked, "([A-Za-z0-9])([.,;:!?])", f"\\1 {_BARE}\\2")
        parts = pc.split_pattern(pc.replace_substring(marked, "\n", f" \n {_BARE}"), " ")
        per_text = np.zeros(len(texts), np.int64)
        per_text[fast] = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        coded = parts.flatten().dictionary_encode()
        place, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        owner = np.repeat(np.arange(len(texts)), per_text)
        slot = self._find(words)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            new = words.take(pa.array(missing)).to_pylist()
            odd = _odd_words(new)
            if odd.any():
                slow.update(owner[np.isin(place, missing[odd])].tolist())
                missing, new = missing[~odd], [w for w, o in zip(new, odd.tolist()) if not o]
            slot[missing] = self._add(new, [w if w == "\n" else w[1:] if w[0] == _BARE else " " + w for w in new])
        codes = slot[place] if len(words) else np.empty(0, np.int64)
        if slow:
            cut = {k: _PIECE.findall(texts[k]) for k in sorted(slow)}
            coded = pa.array([_BARE + _BARE + p for part in cut.values() for p in part],
                             pa.large_string()).dictionary_encode()
            slot = self._find(coded.dictionary)
            missing = np.flatnonzero(slot < 0)
            new = coded.dictionary.take(pa.array(missing)).to_pylist()
            slot[missing] = self._add(new, [w[2:] for w in new])
            keep = ~np.isin(owner, list(cut))
            codes = np.concatenate([codes[keep], slot[coded.indices.to_numpy(zero_copy_only=False)]])
            owner = np.concatenate([owner[keep], np.repeat(list(cut), [len(p) for p in cut.values()])])
            order = np.argsort(owner, kind="stable")
            codes, owner = codes[order], owner[order]
        if not len(codes):
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        self._uses += np.bincount(codes, minlength=len(self._uses))
        n = self._sizes[codes]
        ids = _runs_of(self._flat, self._starts[codes], n)
        return ids, np.bincount(owner, n, minlength=len(texts)).astype(np.int64)


def _runs_of(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _odd_words(words: list[str]) -> np.ndarray:
    """Which results of splitting at spaces hold other white space, control
    characters or nothing; their texts are cut by the pattern instead."""
    def odd(w: str) -> bool:
        bare = w[1:] if w[:1] == _BARE else w
        return w != "\n" and (len(bare.split()) != 1 or bare != bare.strip()
                              or any("\x1c" <= c <= "\x1f" for c in bare))
    joined = " ".join(words).replace(_BARE, "")
    plain = not any(c in joined for c in "\x1c\x1d\x1e")
    if plain and joined.split() == [w for w in joined.split(" ") if w != "\n"]:
        return np.zeros(len(words), bool)
    return np.array([odd(w) for w in words], bool)


def _library_ids(t) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Ids of pieces by the library, many pieces in one call. A space and ASCII
    letters are one pre-token; such pieces go to the library's BPE model one
    after the other: where no token has a space after a letter, none reaches
    into the next piece, and the tokens that begin with a space show where
    pieces begin. Others are joined by line breaks, which the pre-tokenizer
    keeps apart as one token of their own."""
    vocabulary, model, space = t.get_vocab(), t.model, _SPACE
    spaced = np.zeros(max(vocabulary.values()) + 1, bool)
    spaced[[k for w, k in vocabulary.items() if w[0] == space]] = True
    apart = not any(map(re.compile(f"[A-Za-z]{space}").search, vocabulary))
    mark = t.encode("\n", add_special_tokens=False).ids

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, plain, alone = [], [], []
        for k, p in enumerate(pieces):
            if apart and p[0] == " " and p[1:].isalpha() and p.isascii():
                words.append(k)
            elif len(p.split()) == 1 and "\n" not in p and not p[:2].isspace():
                plain.append(k)
            else:
                alone.append(k)
        order, flat, sizes = [], [], []

        def put(group: list[int], ids: np.ndarray, n: np.ndarray) -> None:
            if len(n) != len(group) or n.sum() != len(ids):     # the pieces are not apart here
                alone.extend(group)
                return
            order.append(group)
            flat.append(ids)
            sizes.append(n)

        groups = lambda some: [some[k:k + JOINED] for k in range(0, len(some), JOINED)]
        for group in groups(words):
            text = "".join([pieces[k] for k in group]).replace(" ", space)
            ids = np.array([x.id for x in model.tokenize(text)], "<u4")
            put(group, ids, np.diff(np.append(np.flatnonzero(spaced[ids]), len(ids))))
        joined = groups(plain)
        for group, e in zip(joined, t.encode_batch_fast(["\n".join([pieces[k] for k in g]) for g in joined],
                                                        add_special_tokens=False)):
            ids = np.asarray(e.ids, "<u4")
            ends = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else np.empty(0, np.int64)
            put(group, np.delete(ids, ends), np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1)
        for k, e in zip(alone, t.encode_batch_fast([pieces[k] for k in alone], add_special_tokens=False)):
            put([k], np.asarray(e.ids, "<u4"), np.array([len(e.ids)]))
        if not order:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        n = np.concatenate(sizes).astype(np.int64)
        back = np.argsort(np.concatenate(order))
        return _runs_of(np.concatenate(flat), (np.cumsum(n) - n)[back], n[back]), n[back]
    return encode


class TextEncoder:
    """What ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``
    gives for each text: by pieces, or whole where an added token's string is."""

    def __init__(self, path: str):
        self._path, self._library = path, None
        self._pieces = library_encoder(path)
        self._added = self._pieces.added

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        if self._library is None:       # few workers ever see such a text
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self._path)
        return [np.asarray(e.ids, "<u4") for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``PieceEncoder.encode``."""
        holds = np.array([any(a in t for a in self._added) for t in texts], bool)
        if not holds.any():
            return self._pieces.encode(texts)
        ids, counts = self._pieces.encode(["" if h else t for t, h in zip(texts, holds)])
        whole = self._whole([t for t, h in zip(texts, holds) if h])
        counts[holds] = [len(x) for x in whole]
        inside = np.repeat(holds, counts)
        out = np.empty(len(inside), "<u4")
        out[inside], out[~inside] = np.concatenate(whole), ids
        return out, counts


_ENCODERS: dict[tuple, PieceEncoder | TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """The encoder of whole texts over a vocabulary file; one per worker."""
    key = ("texts", path)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path)
    return _ENCODERS[key]


def library_encoder(path: str) -> PieceEncoder:
    """The tokenizers library over a vocabulary file, for pieces: an added
    token's string counts as ordinary text here; one per worker."""
    key = ("tokenizers", path)
    if key not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True      # their strings in a text are ordinary text
        _ENCODERS[key] = PieceEncoder(_library_ids(t), [
            a.content for a in t.get_added_tokens_decoder().values() if a.content])
    return _ENCODERS[key]


def slices(texts: list[str], most: int = 3_000_000) -> list[slice]:
    """Cuts of a batch so that each holds about ``most`` characters."""
    out, start, total = [], 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > most:
            out.append(slice(start, i))
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        out.append(slice(start, len(texts)))
    return out
