"""Byte-level BPE: encoding by a lazily built transducer, streaming decoding.

Encoding. A sequence of tokens is the merge result of its bytes exactly if
every two neighbours are the merge result of theirs. So each prefix of a text
has one last token: the one that ends there and agrees with the last token of
the prefix before it. ``MergeTransducer`` reads bytes; its state is the last
token that is final and the bytes after it. A token becomes final as soon as
all prefixes that a longer token could still continue agree on it, which needs
at most as many bytes of lookahead as the longest token has. States and steps
are made when first needed (lazy determinisation) and kept in a bounded table.

Decoding. Token bytes are joined and pass ``Utf8Stream``, a state machine that
holds back an unfinished character between calls.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from stratum.llm.common import map_texts, map_values, table

#: bounds of a task's memory: transducer states, remembered word encodings
MAX_STATES = 250_000
MAX_WORDS = 400_000
#: White_Space of Unicode: a cut before white space that follows other text is
#: always a cut of the pattern, so these chunks split alike on their own.
SPACE = "\t-\r \x85\xa0  -     　"
FEW = 6
BYTES = [bytes((b,)) for b in range(256)]
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeTransducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        # proper prefixes of tokens, with what they can grow to where that is little
        grown: dict[bytes, list[bytes]] = {}
        for t in ranks:
            for k in range(1, len(t)):
                grown.setdefault(t[:k], []).append(t)
        self.prefixes = {p: tuple(ts) if len(ts) <= FEW else () for p, ts in grown.items()}
        self.agree: dict[tuple[bytes, bytes], bool] = {}
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self._reset()

    def _reset(self) -> None:
        """Only the start state: nothing read. A state is the pending bytes, for
        each prefix of them where its last token starts and that token (none for
        prefixes that nothing can continue), and the places a later token can
        start at; its steps stand in a table of its own, by byte."""
        self.ids = {}
        self.states: list[tuple[bytes, tuple, list[int]]] = [(b"", ((0, b""),), [0])]
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.ends: dict[int, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """The plain merge procedure, for the few bytes of two tokens."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank, none = self.ranks.get, 1 << 40
        pairs = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge made ``token``; itself twice if none did."""
        got = self.split.get(token)
        if got is None:
            got = (token, token)
            if len(token) > 1:
                rank = self.ranks.pop(token)  # so that the merges stop before it
                parts = self.merge(token)
                self.ranks[token] = rank
                if len(parts) == 2:
                    got = (parts[0], parts[1])
            self.split[token] = got
        return got

    def neighbours(self, left: bytes, token: bytes) -> bool:
        """Whether merging the bytes of both gives just these two tokens.

        Undo merges, the latest first, and look at the two tokens that then meet
        at the border: had they a merge that comes before what was undone, the
        procedure would have joined them across the border instead."""
        got = self.agree.get((left, token))
        if got is not None:
            return got
        if len(self.agree) > 4 * self.max_states:
            self.agree.clear()
        rank, none = self.ranks.get, 1 << 40
        if not left:
            got = len(token) == 1 or self._halves(token)[0] != token
        else:
            a, b, limit, got = left, token, none, True
            while True:
                if rank(a + b, none) < limit:
                    got = False
                    break
                ra = rank(a) if len(a) > 1 else -1
                rb = rank(b) if len(b) > 1 else -1
                if ra < 0 and rb < 0:
                    break
                if ra > rb:  # of two equal tokens the left one was made first
                    limit, a = ra, self._halves(a)[1]
                else:
                    limit, b = rb + 1, self._halves(b)[0]
        self.agree[(left, token)] = got
        return got

    def _path(self, lasts: tuple, end: int) -> tuple[int, ...]:
        out = []
        while end:
            end, token = lasts[end]
            out.append(self.ranks[token])
        return tuple(reversed(out))

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        pending, lasts, starts = self.states[state]
        pending += BYTES[byte]
        size = len(pending)
        last, live = (), []
        ranks, prefixes = self.ranks, self.prefixes
        for start in starts:
            token = pending[start:]
            if not last and token in ranks and self.neighbours(lasts[start][1], token):
                last = (start, token)
            if token in prefixes:
                live.append(start)
        lasts = (*lasts, last)
        # back from the end to the place that every live chain passes
        final = size
        for other in reversed(live):
            while final != other:
                if final > other:
                    final = lasts[final][0]
                else:
                    other = lasts[other][0]
        live.append(size)
        to = self._state(lasts[final][1], pending[final:],
                         tuple([(p[0] - final, p[1]) if p and p[0] >= final else ()
                                for p in lasts[final + 1:]]) if final else lasts[1:],
                         [i - final for i in live] if final else live)
        got = self.steps[state][byte] = (to, self._path(lasts, final) if final else ())
        return got

    def _state(self, left: bytes, pending: bytes, lasts: tuple, starts: list[int]) -> int:
        """Number of a state. Final tokens that nothing still to come can tell
        apart share one: all of them, if no token can start at the border any
        more, else those that agree with the same of the few possible tokens."""
        mark = left
        if pending and starts[0]:
            mark = None
        elif pending and (few := self.prefixes[pending]):
            mark = tuple([self.neighbours(left, t) for t in few])
        key = (mark, pending, lasts)
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.states)
            self.states.append((pending, ((0, left), *lasts), starts))
            self.steps.append({})
        return to

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Token ids of one pre-token."""
        whole = self.ranks.get(word)
        if whole is not None:
            return (whole,)
        if len(self.states) > self.max_states:
            self._reset()
        state, out, steps = 0, [], self.steps
        for byte in word:
            got = steps[state].get(byte) or self._step(state, byte)
            state = got[0]
            if got[1]:
                out += got[1]
        end = self.ends.get(state)
        if end is None:
            pending, lasts, _ = self.states[state]
            end = self.ends[state] = self._path(lasts, len(pending))
        return (*out, *end)


class Utf8Stream:
    """Incremental UTF-8: complete characters come out, an unfinished one waits
    as state (lead byte and continuation bytes seen). Bytes that no character
    can hold become U+FFFD, also what is unfinished at the end."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue  # a continuation byte: look for its lead
            need = 2 if byte & 0xE0 == 0xC0 else 3 if byte & 0xF0 == 0xE0 else 4 if byte & 0xF8 == 0xF0 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def character_classes() -> dict[str, str]:
    """Letters, numbers and white space (``L``, ``N``, ``s``) as the target library's
    own tables have them, as the inside of a character class.

    The library is asked, not another Unicode table: behind ``a``, ``1`` or ``!`` a
    character's first byte merges with it, in a vocabulary that has these pairs, just if
    the pattern takes both into one pre-token."""
    import tiktoken

    marks = {"L": "a", "N": "1", "other": "!"}
    ranks = {bytes((b,)): b for b in range(256)}
    for m in marks.values():
        ranks |= {m.encode() + bytes((b,)): len(ranks) + b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=ranks, special_tokens={})
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    sizes = np.array([len(chr(p).encode()) for p in (0, 0x80, 0x800, 0x10000)])[
        np.searchsorted([0x80, 0x800, 0x10000], points, side="right")] + 2
    starts = np.cumsum(sizes) - sizes
    found, seen = {}, np.zeros(len(points), bool)
    lengths = np.array([1] * 256 + [2] * (len(ranks) - 256))
    for name, mark in marks.items():
        tokens = lengths[probe.encode_to_numpy("".join([f"{mark}{chr(p)}\n" for p in points]))]
        at = np.cumsum(tokens) - tokens
        found[name] = tokens[np.searchsorted(at, starts)] == 2
        seen |= found[name]
    found["s"] = ~seen
    out = {}
    for name in ("L", "N", "s"):
        own = np.array(points)[found[name]]
        first = np.flatnonzero(np.diff(own, prepend=-2) > 1)
        last = np.append(first[1:], len(own)) - 1
        out[name] = "".join([f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(own[first].tolist(), own[last].tolist())])
    return out


def spelled_out(pattern: str, classes: dict[str, str]) -> str:
    """A splitting pattern with its letters, numbers and white space written as ranges."""
    out, inside = [], False
    for part in re.findall(r"\\p\{[LN]\}|\\.|.", pattern, re.DOTALL):
        name = {r"\p{L}": "L", r"\p{N}": "N", r"\s": "s", r"\S": "s"}.get(part)
        if name and inside and part == r"\S":
            raise ValueError(f"{pattern}: a negated class inside brackets")
        if name:
            part = classes[name] if inside else f"[^{classes[name]}]" if part == r"\S" else f"[{classes[name]}]"
        elif part in "[]":
            inside = part == "["
        out.append(part)
    return "".join(out)


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, classes: dict[str, str] | None = None):
        self.transducer = MergeTransducer(ranks)
        self.words = re.compile(spelled_out(pattern, classes or character_classes()))
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        got = self.known[word] = array("I", self.transducer.encode(word.encode())).tobytes()
        return got

    def _chunk(self, chunk: str) -> bytes:
        known = self.known
        return b"".join([known.get(w) or self._word(w) for w in self.words.findall(chunk)])

    def packed(self, text: str) -> bytes:
        """Token ids as unsigned 32-bit numbers. Chunks and words met before are
        remembered, in tables that start anew when full."""
        chunks = CHUNK.findall(text)
        memo = self.chunks
        if len(memo) > MAX_WORDS:
            memo.clear()
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        for c in set(chunks).difference(memo):
            memo[c] = self._chunk(c)
        return b"".join(map(memo.__getitem__, chunks))

    def encode(self, text: str) -> list[int]:
        return memoryview(self.packed(text)).cast("I").tolist()

    def decode_stream(self, ids: list[int], block: int = 8192):
        stream = Utf8Stream()
        for at in range(0, len(ids), block):
            yield stream.feed(b"".join(map(self.bytes_of.__getitem__, ids[at:at + block])))
        yield stream.close()

    def decode(self, ids: list[int]) -> str:
        return "".join(self.decode_stream(ids))


_made: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str, classes: dict[str, str]) -> Codec:
    """A task's codec, kept as long as its worker lives."""
    if (path, pattern) not in _made:
        _made.clear()
        _made[path, pattern] = Codec(load_ranks(path), pattern, classes)
        gc.freeze()  # the tables live as long as the worker: not worth scanning for cycles
        gc.set_threshold(200_000, 20, 50)
    return _made[path, pattern]


def encode_texts(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text (null text: none)."""
    classes = character_classes()

    def setup():
        encode = codec(ranks_path, pattern, classes).encode
        return lambda texts: [[encode(t) for t in texts]]
    return map_texts(df, setup, [StructField("ids", ArrayType(IntegerType()))], id_col, text_col)


def decode_ids(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from id lists (null or empty list: empty text)."""
    source = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    classes = character_classes()

    def setup():
        decode = codec(ranks_path, pattern, classes).decode
        return lambda lists: [[decode(x or []) for x in lists]]
    return map_values(source, setup, [StructField("text", StringType())])


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, return digests of both:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null and empty texts have no tokens and the digests of nothing; repeated
    rows and null ids stay rows of their own; extra columns are not carried."""
    classes = character_classes()

    def setup():
        c = codec(ranks_path, pattern, classes)
        names = {i: str(i) for i in c.bytes_of}

        def digest(texts):
            n, ids_hex, text_hex = [], [], []
            for text in texts:
                ids = c.encode(text)
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                back = hashlib.sha256()
                for part in c.decode_stream(ids):
                    back.update(part.encode())
                text_hex.append(back.hexdigest())
            return [n, ids_hex, text_hex]
        return digest

    return map_texts(df, setup, [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
                                 StructField("decoded_sha256", StringType())], id_col, text_col)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
