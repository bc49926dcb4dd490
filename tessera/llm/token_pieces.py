"""Tokenising many texts at once by vocabulary pieces.

Both vocabularies cut a text by a pattern before any merge: letter runs, digits, marks
and white space. A cut at a place where every match must end, whatever follows, leaves
the ids unchanged, so a batch of texts is cut at such places with numpy, equal pieces are
found by Arrow's exact dictionary, each different piece is encoded by the tokenizers
library once and remembered, and the ids are gathered by position. Pieces repeat far more
often than words between spaces.

Places next to bytes whose class is not known from ASCII alone (Unicode white space, the
separators 0x1C to 0x1F, letters beyond ASCII) are never cut except at plain ASCII white
space, so such words stay whole and the library decides.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tessera.llm.common import LOWER, byte_class

SEP, SPACE, LETTER, DIGIT, MARK, HIGH, UNSURE = range(7)
END_OF_TEXT = 0xFF  # no byte of UTF-8
JOIN = 500
CHUNK = 4 << 20  # bytes of text worked on at once; fewer different pieces a byte than in small chunks

_CLASS = np.full(256, MARK, np.uint8)
_CLASS[byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")] = SPACE
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[128:] = HIGH
_CLASS[0x1C:0x20] = UNSURE
_CLASS[END_OF_TEXT] = SEP

#: First bytes of the UTF-8 forms of white space beyond ASCII.
_LEADS = byte_class(b"\xc2\xe1\xe2\xe3")


def classes(buf: np.ndarray) -> np.ndarray:
    """Class of every byte; bytes of characters that are or may be Unicode white space
    (U+0085, U+00A0, U+1680, U+2000 to U+207F, U+3000 to U+303F) are unsure. U+00C0 to
    U+024F are letters, but for the signs for times and division and U+0130, which
    lower-cases to a letter and a mark."""
    out = _CLASS[buf]
    at = np.flatnonzero(_LEADS[buf])
    if len(at):
        second, third = buf[np.minimum(at + 1, len(buf) - 1)], buf[np.minimum(at + 2, len(buf) - 1)]
        lead = buf[at]
        two = (lead == 0xC2) & ((second == 0x85) | (second == 0xA0))
        three = (((lead == 0xE1) & (second == 0x9A) & (third == 0x80))
                 | ((lead == 0xE2) & ((second == 0x80) | (second == 0x81)))
                 | ((lead == 0xE3) & (second == 0x80)))
        for k in range(3):
            out[at[three] + k] = UNSURE
        for k in range(2):
            out[at[two] + k] = UNSURE
    lead = np.flatnonzero((buf >= 0xC3) & (buf <= 0xC9))
    if len(lead):
        code = (buf[lead].astype(np.int64) & 31) << 6 | (buf[lead + 1] & 63)
        lead = lead[(code < 0x250) & (code != 0xD7) & (code != 0xF7) & (code != 0x130)]
        out[lead] = out[lead + 1] = LETTER
    return out


def cuts(buf: np.ndarray, spaced: bool) -> np.ndarray:
    """Start of every piece. ``spaced``: a word's piece begins with its one space, as in
    byte-level vocabularies; otherwise white space is dropped by the vocabulary and
    digits stand alone."""
    cls = classes(buf)
    a, b = cls[:-1], cls[1:]
    known = (a < HIGH) & (b < HIGH) & (a != SPACE) & (b != SPACE)
    cut = known & (a != b)
    cut &= ~((buf[:-1] == 0x27) & (b == LETTER))
    into = (b == SPACE) & (a != SPACE) & (a != UNSURE)
    cut |= into | (a == SEP) | (b == SEP)
    out = (a == SPACE) & (b != SPACE) & (b != SEP) & (b != UNSURE)
    if not spaced:
        cut |= out | ((a == DIGIT) & (b == DIGIT))
        return np.flatnonzero(np.concatenate([[True], cut]))
    cut = np.concatenate([[True], cut])
    ends = np.flatnonzero(out) + 1  # first byte after a run of white space
    space = cls == SPACE
    begins = np.flatnonzero(space & np.concatenate([[True], ~space[:-1]]))
    first = begins[np.searchsorted(begins, ends, "right") - 1] if len(ends) else ends
    sure = (first == 0) | (cls[first - 1] != UNSURE)
    ends, first = ends[sure], first[sure]
    cut[ends[ends - first >= 2] - 1] = True
    cut[ends[buf[ends - 1] != 0x20]] = True
    return np.flatnonzero(cut)


def ragged(offsets: np.ndarray, lengths: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Positions of the elements of the picked groups, one group after the other."""
    size = lengths[picks]
    before = np.cumsum(size) - size
    return np.repeat(offsets[picks] - before, size) + np.arange(int(size.sum()))


class PieceMemo:
    """The ids of pieces in two generations of at most ``cap`` pieces in all; the older one
    is dropped when the younger has filled up. ``fill(pieces)`` gives missing values."""

    def __init__(self, fill, cap: int):
        self.fill, self.half = fill, max(1, cap // 2)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def values(self, pieces: list[bytes]) -> list[bytes]:
        out = list(map(self.new.get, pieces))
        missing = [i for i, v in enumerate(out) if v is None]
        unknown = []
        for i in missing:
            out[i] = self.old.get(pieces[i])
            if out[i] is None:
                unknown.append(i)
        for i, v in zip(unknown, self.fill([pieces[i] for i in unknown])):
            out[i] = v
        if len(self.new) + len(missing) > self.half:
            self.old, self.new = self.new, {}
        for i in missing if len(missing) <= self.half else missing[:self.half]:
            self.new[pieces[i]] = out[i]
        return out


_loaded: dict = {}


def _memo(path: str, special_as_text: bool, cap: int) -> PieceMemo:
    """Per worker process: memo from a piece to the bytes of its ids."""
    key = (path, special_as_text, cap)
    if key not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        joined, literal = Tokenizer.from_file(path), []

        def single() -> Tokenizer:
            """The tokenizer for pieces that may hold special tokens; rarely needed, so a second
            one that reads them as text is loaded on first use only."""
            if not special_as_text:
                return joined
            if not literal:
                literal.append(Tokenizer.from_file(path))
                literal[0].encode_special_tokens = True
            return literal[0]

        special = {t.content: i for i, t in joined.get_added_tokens_decoder().items()}
        mark = next((c for i, c in sorted((i, c) for c, i in special.items())
                     if not ((t := joined.get_added_tokens_decoder()[i]).lstrip or t.rstrip or t.single_word)), None)

        def ids_of(tokenizer, texts):
            return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def fill(pieces: list[bytes]) -> list[bytes]:
            """Pieces are encoded many at a time with a special token between them; those
            that could hold a special token themselves go one by one."""
            texts = [p.decode("utf-8", "replace") for p in pieces]
            alone = {i for i, t in enumerate(texts) if mark is None or any(s in t for s in special)}
            out: list[bytes] = [b""] * len(texts)
            if alone:
                for i, ids in zip(sorted(alone), ids_of(single(), [texts[i] for i in sorted(alone)])):
                    out[i] = ids.tobytes()
            rest = [i for i in range(len(texts)) if i not in alone]
            for s in range(0, len(rest), JOIN):
                part = rest[s:s + JOIN]
                ids = ids_of(joined, [mark.join([texts[i] for i in part])])[0]
                ends = np.append(np.flatnonzero(ids == special[mark]), len(ids)).tolist()
                data, start = ids.tobytes(), 0
                for i, end in zip(part, ends, strict=True):
                    out[i] = data[4 * start:4 * end]
                    start = end + 1
            return out

        _loaded[key] = PieceMemo(fill, cap)
    return _loaded[key]


def token_ids(texts: list[bytes], path: str, end_id: int | None, spaced: bool, lower: bool = False,
              special_as_text: bool = True, memo_pieces: int = 800_000) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, offsets of each text in them): the ids of the
    tokenizers library without special tokens of its own, then ``end_id`` if given.

    ``lower``: the vocabulary lower-cases, so A-Z may be lowered beforehand. With
    ``special_as_text`` the strings of special tokens are ordinary text, as in the
    vocabulary's documentation; without it they become special ids, so a text that holds
    one is left whole."""
    memo = _memo(path, special_as_text, memo_pieces)
    whole = [] if special_as_text else [i for i, t in enumerate(texts) if b"<|" in t]
    if whole:
        marked = set(whole)
        cut_texts = [b"" if i in marked else t for i, t in enumerate(texts)]
    else:
        cut_texts = texts
    buf = np.frombuffer(b"\xff".join(cut_texts) + b"\xff", np.uint8)
    if lower:
        buf = LOWER[buf]
    starts = cuts(buf, spaced)
    ends = np.append(starts[1:], len(buf))
    sep = buf[starts] == END_OF_TEXT
    text_of_end = np.cumsum(sep)
    keep = ~sep
    at, size, owner = starts[keep], (ends - starts)[keep], text_of_end[keep]
    data = buf[buf != END_OF_TEXT]
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    table = coded.dictionary
    ends_at, raw = np.frombuffer(table.buffers()[1], np.int64)[:len(table) + 1].tolist(), (table.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    distinct = [raw[a:b] for a, b in zip(ends_at, ends_at[1:])]
    picks = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    values = memo.values(distinct)
    # the end id and the texts left whole are groups of their own behind the distinct pieces;
    # they follow the pieces of their text, of which a text left whole has none
    groups = values + memo.fill([texts[i] for i in whole]) if whole else values
    tail = [np.array(whole, np.int64)] if whole else []
    tail_picks = [np.arange(len(values), len(groups))] if whole else []
    if end_id is not None:
        tail.append(np.arange(len(texts)))
        tail_picks.append(np.full(len(texts), len(groups)))
        groups = [*groups, np.array([end_id], "<u4").tobytes()]
    if tail:
        extra, extra_picks = np.concatenate(tail), np.concatenate(tail_picks)
        order = np.argsort(extra, kind="stable")
        extra, extra_picks = extra[order], extra_picks[order]
        slots = np.empty(len(picks) + len(extra), np.int64)
        at_extra = np.searchsorted(owner, extra, "right") + np.arange(len(extra))
        mine = np.ones(len(slots), bool)
        mine[at_extra] = False
        slots[at_extra], slots[mine] = extra_picks, picks
        owners = np.empty(len(slots), np.int64)
        owners[at_extra], owners[mine] = extra, owner
        picks, owner = slots, owners
    flat = np.frombuffer(b"".join(groups), "<u4")
    lengths = np.fromiter(map(len, groups), np.int64, len(groups)) // 4
    offsets = np.cumsum(lengths) - lengths
    ids = flat[ragged(offsets, lengths, picks)] if len(picks) else np.empty(0, "<u4")
    totals = np.concatenate([[0], np.cumsum(lengths[picks])])
    return ids, totals[np.searchsorted(owner, np.arange(len(texts) + 1))]
