"""Byte-level BPE over Arrow batches of texts.

A text is cut at every single space that stands between two characters that
are not white space. No pre-token of the vocabulary's pattern spans such a
place (a pre-token may only begin with the space), so the tokens of a text
are the tokens of its pieces one after the other, each piece with its space in
front. Pieces recur, so each distinct piece of a batch is encoded once, and a
bounded memo carries results from batch to batch.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers.pre_tokenizers import ByteLevel

# The pattern of the byte-level pre-tokenizer.
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _unassigned() -> re.Pattern:
    """Characters that the interpreter's Unicode version does not assign."""
    free = [unicodedata.category(chr(o)) == "Cn" for o in range(0x110000)] + [False]
    edges = [o for o in range(1, len(free)) if free[o] != free[o - 1]]
    return re.compile("[" + "".join(rf"\U{a:08x}-\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2])) + "]")


_UNASSIGNED = _unassigned()
_PRETOKENIZER = ByteLevel(add_prefix_space=False)


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text. Libraries differ in the Unicode version that says
    what a letter is; where that may matter, the tokenizers library decides."""
    if text.isascii() or not _UNASSIGNED.search(text):
        return PRETOKEN.findall(text)
    return [text[a:b] for _, (a, b) in _PRETOKENIZER.pre_tokenize_str(text)]


#: Texts in which a space has white space beside it, or stands at an end.
_ODD = r"^ | $|[\pZ\x09-\x0d\x1c-\x1f\x{85}] | [\pZ\x09-\x0d\x1c-\x1f\x{85}]"
_CUT = re.compile(r"(?<=\S) (?=\S)")

#: Bounds on memory, not on results: texts are taken in slices of about this
#: many bytes, and the memo is emptied when it holds this many pieces.
SLICE_BYTES = 8 << 20
MEMO_PIECES = 300_000


def vocabulary_path(name_or_path: str) -> str:
    """A path as given; a bare file name is looked up in public_tokenizers."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers
    return public_tokenizers.path(name_or_path)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, pa.ListArray]]:
    """Rows of the batch, about `limit` bytes of text at a time (a longer text
    stands alone), with the pieces of each row; every text has at least one,
    the first being without a space in front."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, base = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, "right")))
        part = texts.slice(lo, hi - lo)
        odd = pc.match_substring_regex(part, _ODD)
        rows = np.arange(lo, hi)
        is_odd = odd.to_numpy(zero_copy_only=False)
        if not is_odd.all():
            yield rows[~is_odd], pc.split_pattern(part.filter(pc.invert(odd)), " ")
        if is_odd.any():
            cut = [_CUT.split(t) for t in part.filter(odd).to_pylist()]
            yield rows[is_odd], pa.array(cut, pa.list_(pa.string()))
        base, lo = int(sizes[hi - 1]), hi


def pieces(parts: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str], list[str]]:
    """(codes, starts, distinct, firsts): row i is the pieces
    codes[starts[i]:starts[i+1]] of `distinct`, its first one firsts[i]."""
    coded = parts.flatten().dictionary_encode()
    starts = np.r_[0, np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))]
    codes = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary.to_pylist()
    return codes, starts, distinct, [distinct[c] for c in codes[starts[:-1]]]


class Memo:
    """Bounded map from a piece to its result; misses are computed together."""

    def __init__(self, compute: Callable[[list[str]], list], limit: int = MEMO_PIECES):
        self._compute, self._limit, self._known = compute, limit, {}

    def __call__(self, wanted: list[str]) -> list:
        known = self._known
        missing = list(dict.fromkeys(w for w in wanted if w not in known))
        if len(known) + len(missing) > self._limit:
            known = self._known = {}
            missing = list(dict.fromkeys(wanted))
        known.update(zip(missing, self._compute(missing)))
        return [known[w] for w in wanted]


def byte_symbols() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies use for each byte:
    printable Latin-1 bytes stand for themselves, the others, in order, for
    the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Rank-synchronous BPE: every round merges, in each sequence at once, all
    places of that sequence's lowest-rank pair.

    A pair that a merge creates holds the new symbol and so has a higher rank
    than the merge that made the symbol. Taking all places of the lowest pair
    in one round therefore gives what merging one place after the other gives;
    in a run of equal symbols places are taken from the left, every second.
    """

    NONE = np.int32(np.iinfo(np.int32).max)

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, stand_in = spec["model"], byte_symbols()
        vocab: dict[str, int] = model["vocab"]
        self.byte_ids = np.zeros(256, np.int32)
        for symbol, byte in stand_in.items():
            self.byte_ids[byte] = vocab[symbol]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        self.specials = [t["content"] for t in spec.get("added_tokens") or []]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], self.NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string after all merges."""
        n = np.array([len(t) for t in tokens], np.int64)
        out = n.copy()
        ids = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        live = np.flatnonzero(n)  # the sequences that ids still holds
        seq = np.repeat(np.arange(len(live)), n[live])
        rank = np.full(len(ids), self.NONE, np.int32)
        inner = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inner] = self.ranks(ids[inner], ids[inner + 1])
        while len(ids):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            best = np.minimum.reduceat(rank, starts)
            open_ = best != self.NONE
            if not open_.all():  # set finished sequences aside
                out[live] = np.diff(np.r_[starts, len(ids)])
                keep = open_[seq]
                ids, rank, live, best = ids[keep], rank[keep], live[open_], best[open_]
                seq = (np.cumsum(open_) - 1)[seq[keep]]
                if not len(ids):
                    break
            hit = rank == best[seq]
            at = np.flatnonzero(hit)
            if (hit[1:] & hit[:-1]).any():  # a run of one symbol: every second place
                run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) > 1], np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            ids[at] = self.result[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1  # where the merged symbols end up
            ids, rank, seq = ids[keep], rank[keep], seq[keep]
            touched = np.r_[new, new[new > 0] - 1]
            rank[touched] = self.NONE
            touched = touched[touched < len(ids) - 1]
            touched = touched[seq[touched] == seq[touched + 1]]
            rank[touched] = self.ranks(ids[touched], ids[touched + 1])
        return out

    def count_pieces(self, wanted: list[str]) -> list[int]:
        """Tokens of each piece, its special strings counted as one token."""
        special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        tokens: dict[str, int] = {}
        flat, sizes = [], []
        total = np.zeros(len(wanted), np.int64)
        for i, piece in enumerate(wanted):
            if special and special.search(piece):
                parts = special.split(piece)
                total[i] = len(parts) - 1
                found = [t for part in parts for t in pretokens(part)]
            else:
                found = pretokens(piece)
            sizes.append(len(found))
            flat += [tokens.setdefault(t, len(tokens)) for t in found]
        if flat:
            counts = self.count([t.encode() for t in tokens])
            total += np.bincount(np.repeat(np.arange(len(wanted)), sizes),
                                 counts[np.array(flat)], len(wanted)).astype(np.int64)
        return total.tolist()
