"""Byte-level BPE as a finite-state transducer, and streaming decoding.

Encoding. A rank file's merges have a local characterisation: a token sequence is the
encoding of its bytes exactly when every token encodes to itself and every adjacent
pair of tokens is stable, i.e. merging the bytes of both gives the pair back. So the
encoding of a prefix ends in one certain token, and reading left to right needs only
the *live* starts: positions from which the bytes read so far could still be the
beginning of a longer token. The transducer's state is the set of live starts with
the token chains that lead to them; what all chains share is certain and is emitted.
The lookahead is bounded by the longest token. States and transitions are created
when first needed (lazy determinisation) and kept while a task runs, up to
``MAX_STATES``.

Texts are cut by the vocabulary's pattern first; the transducer runs over each match.
A two-generation memo of bounded size holds frequent matches, so that a match seen
again costs one lookup.

Decoding. Token bytes are joined and validated by an incremental UTF-8 state machine
(the codec's incremental decoder) that takes a chunk of tokens at a time and carries its
state over chunk ends; tokens may end inside a character. Bytes that no text can have,
or an end inside a character, raise.

Defined results: null and empty texts have no tokens and decode to empty bytes. Rows
are treated one by one: repeated rows repeat their result, extra columns are ignored
and empty tables give empty results. Bytes that are not UTF-8 (Spark can hold them)
are encoded as U+FFFD. An unknown id raises.
"""

from __future__ import annotations

import base64
import codecs

from pyspark.sql import DataFrame

from tessera.llm.common import Memo, map_arrow

MAX_STATES = 250_000
MAX_PAIRS = 200_000
MEMO_WORDS = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Textbook merging: join the adjacent pair of the lowest rank, leftmost first."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


_ONE = [bytes((b,)) for b in range(256)]


class State:
    __slots__ = ("chains", "tail", "next", "final")

    def __init__(self, chains: tuple, tail: bytes):
        self.chains = chains    # ((start in tail, tokens from the commit point to it, last token before it), ...)
        self.tail = tail        # bytes since the commit point
        self.next: dict[int, tuple] = {}
        self.final: tuple | None = None


class Transducer:
    """``encode(piece)`` of one pattern match."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.begins: set[bytes] = set()
        for token in ranks:
            self.begins.update(token[:i] for i in range(1, len(token)))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self):
        self.states: dict[tuple, State] = {}
        self.start = self._state(((0, (), None),), b"")

    def _state(self, chains: tuple, tail: bytes) -> State:
        key = (chains, tail)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(chains, tail)
        return found

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte."""
        if token not in self.halves:
            parts, text = None, self.bytes_of[token]
            if len(text) > 1:
                smaller = {t: r for t, r in self.ranks_below(text, token)}
                parts = tuple(merge_bytes(text, smaller))
                if len(parts) != 2:
                    raise ValueError(f"token {token} is not the merge of two tokens of lower rank")
            self.halves[token] = parts
        return self.halves[token]

    def ranks_below(self, text: bytes, limit: int):
        """The tokens inside ``text`` that rank lower than ``limit``."""
        for i in range(len(text)):
            for j in range(i + 1, len(text) + 1):
                r = self.ranks.get(text[i:j])
                if r is not None and r < limit:
                    yield text[i:j], r

    def stable(self, left: int | None, right: int) -> bool:
        """Whether two adjacent tokens stay as they are when their bytes are merged.

        Seen backwards in time, each token is undone into the halves it was merged
        from, the later merge first. The pair is unstable when at some moment the two
        parts at the border could merge at a lower rank than the merge that was made."""
        if left is None:
            return True
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        a, b, made = left, right, 1 << 60
        known, ranks, text, halves = True, self.ranks, self.bytes_of, self.halves
        while True:
            joint = ranks.get(text[a] + text[b])
            if joint is not None and joint < made:
                known = False
                break
            halves_a = halves[a] if a in halves else self._split(a)
            halves_b = halves[b] if b in halves else self._split(b)
            if halves_b is None:
                if halves_a is None:
                    break
                made, a = a, halves_a[1]
            elif halves_a is not None and a > b:
                made, a = a, halves_a[1]
            else:
                # at equal ranks the left one of two possible merges is made first
                made, b = b + 1, halves_b[0]
        self.pairs[left, right] = known
        return known

    def _move(self, state: State, byte: int) -> tuple:
        """(emitted tokens, next state) on one byte."""
        tail = state.tail + _ONE[byte]
        live, reached = [], None
        for entry in state.chains:
            part = tail[entry[0]:]
            if reached is None:
                token = self.ranks.get(part)
                if token is not None and self.stable(entry[2], token):
                    reached = (len(tail), (*entry[1], token), token)
            if part in self.begins:
                live.append(entry)
        if reached is not None:
            live.append(reached)
        if not live:
            raise ValueError("the rank file lacks single bytes")
        first = live[0][1]
        shared = min(len(c[1]) for c in live)
        for c in live[1:]:
            k = 0
            while k < shared and c[1][k] == first[k]:
                k += 1
            shared = k
        if not shared:
            return (), self._state(tuple(live), tail)
        out = first[:shared]
        cut = sum([len(self.bytes_of[t]) for t in out])
        return out, self._state(tuple([(s - cut, c[shared:], last) for s, c, last in live]), tail[cut:])

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > MAX_STATES:
            self.reset()
        state, out = self.start, []
        for byte in piece:
            step = state.next.get(byte)
            if step is None:
                step = state.next[byte] = self._move(state, byte)
            if step[0]:
                out += step[0]
            state = step[1]
        if state.final is None:
            state.final = next(c for s, c, _ in state.chains if s == len(state.tail))
        out += state.final
        return out


_loaded: dict = {}


def _encoder(path: str, pattern: str):
    """Per worker process: (compiled pattern, memo from match to its ids as text)."""
    if ("encode", path) not in _loaded:
        import regex
        machine = Transducer(load_ranks(path))

        def fill(pieces):
            return [" ".join(map(str, machine.encode(p.encode()))) + " " for p in pieces]

        _loaded["encode", path] = regex.compile(pattern), Memo(fill, MEMO_WORDS)
    return _loaded["encode", path]


def encode_texts(texts: list[bytes], rank_file: str, pattern: str) -> list[str]:
    """Decimal ids joined by one space of each text."""
    cut, memo = _encoder(rank_file, pattern)
    found = [cut.findall(t.decode("utf-8", "replace")) for t in texts]
    known = memo.ready(set().union(*found))
    return ["".join(map(known.__getitem__, f))[:-1] for f in found]


def _count(ids: str) -> int:
    return ids.count(" ") + 1 if ids else 0


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal ids joined by one space) of every whole text.

    ``rank_file`` is the vocabulary's place, the same on every executor."""

    def encode(cols, texts):
        ids = encode_texts(texts, rank_file, pattern)
        return {"doc_id": cols["doc_id"], "n_tokens": [_count(i) for i in ids], "ids": ids}

    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    return map_arrow(source, encode, f"doc_id {kind}, n_tokens bigint, ids string", ["doc_id", "text"], "text")


def _tokens(path: str) -> dict[str, bytes]:
    if ("decode", path) not in _loaded:
        _loaded["decode", path] = {str(v): k for k, v in load_ranks(path).items()}
    return _loaded["decode", path]


STREAM_TOKENS = 4096


def decode_ids(ids: str, token_bytes: dict[str, bytes]) -> tuple[bytes, int]:
    """(bytes, characters): tokens are read in chunks of STREAM_TOKENS, each joined and
    passed through the state machine before the next is read."""
    machine, out, chars = codecs.getincrementaldecoder("utf-8")("strict"), [], 0
    names = ids.split()
    for a in range(0, len(names), STREAM_TOKENS):
        chunk = b"".join(map(token_bytes.__getitem__, names[a:a + STREAM_TOKENS]))
        chars += len(machine.decode(chunk))
        out.append(chunk)
    machine.decode(b"", final=True)
    return b"".join(out), chars


def decode_documents(tokens: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (binary), n_chars of ``encode_documents`` rows."""

    def decode(cols, texts):
        table = _tokens(rank_file)
        done = [decode_ids(t.decode(), table) for t in texts]
        return {"doc_id": cols["doc_id"], "n_tokens": cols["n_tokens"], "ids": [t.decode() for t in texts],
                "decoded": [d[0] for d in done], "n_chars": [d[1] for d in done]}

    kind = dict(tokens.dtypes)["doc_id"]
    return map_arrow(tokens, decode, f"doc_id {kind}, n_tokens bigint, ids string, decoded binary, n_chars bigint",
                     ["doc_id", "n_tokens", "ids"], "ids")


def round_trip_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode_documents`` of ``encode_documents`` in one pass: the ids stay in the task
    and one worker process holds both tables."""

    def both(cols, texts):
        ids, table = encode_texts(texts, rank_file, pattern), _tokens(rank_file)
        done = [decode_ids(i, table) for i in ids]
        return {"doc_id": cols["doc_id"], "n_tokens": [_count(i) for i in ids], "ids": ids,
                "decoded": [d[0] for d in done], "n_chars": [d[1] for d in done]}

    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    return map_arrow(source, both, f"doc_id {kind}, n_tokens bigint, ids string, decoded binary, n_chars bigint",
                     ["doc_id", "text"], "text")
