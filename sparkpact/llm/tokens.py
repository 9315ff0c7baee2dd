"""Token ids of whole texts, with a store of the pieces already seen.

The tokenizers here split a text before they merge, always in front of a space or line end that is followed by a
visible character (and for a line end: follows one), and between a letter or digit and one of ``.,;:!?``. So texts are
cut there, each distinct piece is encoded once by the tokenizers library and kept, and the ids of a text are those
of its pieces in order: the same ids as for the whole text. Texts are handled as UTF-8 bytes; where a byte leaves it open what it is, nothing is cut.

That holds for tokenizers that split and normalise as in ``SPLITS``, and whose added tokens hold no such cut and take no
blanks along. Any other tokenizer gets whole texts.

Pieces are known by two independent 64-bit hashes. Should one hash fall together for pieces that the other tells
apart, the texts at hand are encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from sparkpact.llm.base import BASE, BYTE_VALUES, prefix_sums, span_hashes, utf8

#: Distinct pieces that a worker keeps; others are encoded anew in each step. Bounds memory, not results.
KEPT_PIECES = 1_200_000
#: Longer pieces (in bytes) are never kept.
KEPT_LENGTH = 64
#: Pieces encoded in one go.
TOGETHER = 100

# The normalizers and pre-tokenizers, as their files state them, for which texts may be cut.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_LEVEL = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_LOWER_LINES = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
SPLITS = ((None, _BYTE_LEVEL), (_LOWER_LINES, _WORD_LEVEL))

_OTHER = 0xD1342543DE82EF95
#: A piece that may stand beside others: it begins where a text is cut and ends in something visible.
_MEETS = re.compile(r"[ \n][!-~\w](?s:.*\S)?\Z")
_ENCODERS: dict[str, Encoder] = {}

# First bytes of characters that are visible and join nothing before them: ASCII, and letters of Latin, Greek,
# Cyrillic and Han blocks that hold no blanks and no combining marks.
_VISIBLE = np.zeros(256, bool)
for _a, _b in ((0x21, 0x7E), (0xC3, 0xCB), (0xCE, 0xD1), (0xE4, 0xE9)):
    _VISIBLE[_a : _b + 1] = True
#: First bytes of such characters of two bytes.
_TWO = _VISIBLE.copy()
_TWO[:0x80] = _TWO[0xE0:] = False
#: First bytes of two-byte letters; of those the two signs of U+00C0..U+00FF are none.
_LETTER = np.zeros(256, bool)
_LETTER[0xC3:0xCB] = True
_ALNUM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _ALNUM[_a : _b + 1] = True
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".,;:!?"]] = True


def piece_begins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of some texts begin: each text's first byte, and the cuts inside."""
    n = len(data)
    follows = np.zeros(n, bool)
    follows[:-1] = _VISIBLE[data[1:]]
    visible_before = np.zeros(n, bool)
    visible_before[1:] = (data[:-1] >= 0x21) & (data[:-1] <= 0x7E)
    visible_before[2:] |= _TWO[data[:-2]]
    letter_before = np.zeros(n, bool)
    letter_before[1:] = _ALNUM[data[:-1]]
    sign = (data[:-2] == 0xC3) & ((data[1:-1] == 0x97) | (data[1:-1] == 0xB7))
    letter_before[2:] |= _LETTER[data[:-2]] & (data[1:-1] >= 0x80) & ~sign
    cut = follows & ((data == 32) | ((data == 10) & visible_before))
    stops = _STOPS[data] & letter_before
    # A text's last byte has nothing of its own behind it, its first nothing before it.
    ends = offsets[1:][np.diff(offsets) > 0]
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[ends - 1] = False
    cut |= stops
    cut[begins] = True
    return np.flatnonzero(cut)


def may_cut(settings: dict) -> bool:
    """Whether a tokenizer with these settings gives the ids of a text piece by piece."""
    if (settings["normalizer"], settings["pre_tokenizer"]) not in SPLITS or settings["model"].get("dropout") or settings["truncation"] or settings["padding"]:
        return False
    for token in settings["added_tokens"]:
        content = np.frombuffer(token["content"].encode(), np.uint8)
        if token["lstrip"] or token["rstrip"] or token["single_word"] or len(piece_begins(content, np.array([0, len(content)]))) > 1:
            return False
    return True


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = may_cut(json.loads(self.tokenizer.to_str()))
        # Ids of all known pieces one after another, and where each piece's begin.
        self.ids, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # Hashes of the known pieces in order, the other hash, and their numbers.
        self.hashes, self.checks, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has.

        Pieces that begin with a cut and end in no blank are encoded ``TOGETHER``: side by side
        they are cut again where they meet, and offsets tell whose each id is.
        """
        alone, joined = [], []
        for i, piece in enumerate(pieces):
            (joined if _MEETS.match(piece) else alone).append(i)
        groups = [[i] for i in alone] + [joined[k : k + TOGETHER] for k in range(0, len(joined), TOGETHER)]
        ids, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(groups), 100):
            some = groups[at : at + 100]
            for group, found in zip(some, self.tokenizer.encode_batch(["".join([pieces[i] for i in g]) for g in some], add_special_tokens=False)):
                ids.append(np.array(found.ids, np.uint32))
                if len(group) == 1:
                    owners.append(np.full(len(ids[-1]), group[0]))
                    continue
                begins = np.cumsum([0] + [len(pieces[i]) for i in group[:-1]])
                chars = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids[-1]))
                owners.append(np.array(group, np.int64)[np.searchsorted(begins, chars, side="right") - 1])
        ids, owners = np.concatenate(ids), np.concatenate(owners)
        return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(pieces))

    def encode(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_bytes(*utf8(pa.array(texts, pa.large_string())), end)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text's followed by ``end``; and where each text begins, with the end of the last."""
        if not self.cuts:
            return self._whole(data, offsets, end)
        begins = piece_begins(data, offsets)
        ends = np.append(begins[1:], len(data)) if len(begins) else begins
        values = BYTE_VALUES[data]
        hashes = span_hashes(prefix_sums(values, BASE), begins, ends, BASE)
        checks = span_hashes(prefix_sums(values, _OTHER), begins, ends, _OTHER)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        near = np.minimum(at, max(0, len(self.hashes) - 1))
        known = np.zeros(len(distinct), bool)
        if len(self.hashes):
            known = (at < len(self.hashes)) & (self.hashes[near] == distinct)
        if (checks[first][which] != checks).any() or (known.any() and (self.checks[near[known]] != checks[first][known]).any()):
            return self._whole(data, offsets, end)
        ids, begin = self.ids, self.begin
        number = np.empty(len(distinct), np.int64)
        number[known] = self.numbers[near[known]] if known.any() else 0
        fresh = np.flatnonzero(~known)
        if len(fresh):
            spans = zip(begins[first[fresh]].tolist(), ends[first[fresh]].tolist())
            more, counts = self._new([data[a:b].tobytes().decode() for a, b in spans])
            number[fresh] = len(begin) - 1 + np.arange(len(fresh))
            ids = np.concatenate((ids, more))
            begin = np.concatenate((begin, begin[-1] + np.cumsum(counts)))
        order = number[which]
        lengths = begin[order + 1] - begin[order]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        out = ids[np.arange(sums[-1]) + np.repeat(begin[order] - sums[:-1], lengths)]
        out_offsets = sums[np.searchsorted(begins, offsets)]
        if end is not None:
            out = np.insert(out, out_offsets[1:], end)
            out_offsets = out_offsets + np.arange(len(out_offsets))
        if len(fresh) and len(begin) <= KEPT_PIECES:
            self.ids, self.begin = ids, begin
            short = fresh[(ends - begins)[first[fresh]] <= KEPT_LENGTH]
            place = np.searchsorted(self.hashes, distinct[short])
            self.hashes = np.insert(self.hashes, place, distinct[short])
            self.checks = np.insert(self.checks, place, checks[first[short]])
            self.numbers = np.insert(self.numbers, place, number[short])
        return out, out_offsets

    def _whole(self, data: np.ndarray, offsets: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The same by the library alone."""
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
        ids = [e.ids + ([] if end is None else [end]) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.array([i for own in ids for i in own], np.uint32), np.concatenate(([0], np.cumsum([len(i) for i in ids], dtype=np.int64)))


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
