"""Token counts from a byte-pair tokenizer compiled to finite-state transducers.

Two machines read a text. Both are deterministic, and their transitions are
annotated with the tokens they emit.

``PreTokens`` has five states over classes of characters and emits one
pre-token at each transition that begins one (a run of letters, one number
character, a run of other marks, a contraction). A text is cut into chunks of
fixed length; each chunk's map from entry state to exit state is computed for
all chunks at once, the maps compose through a parallel prefix scan, and the
entry states they give yield the emissions of all chunks at once. No chunk
waits for the one before, so one very long text costs what many short ones do.

``Merges`` reads the bytes of a pre-token. Its state is what later bytes can
depend on: for every suffix that begins a token, the token before that suffix
and the count there relative to here, and the last token of the prefix read.
A token can follow another only if the merge rules leave the two as they are,
which makes the last token of every prefix unique; a transition emits the
change of the count. States and transitions are compiled when first needed;
counts of whole pre-tokens are remembered up to a bound.

The vocabulary file is one of the tokenizers library with NFC, white-space and
lower-case normalising, a word / number / mark split and an end-of-word mark.
Its added tokens count one each wherever they stand, as the library's default
has it; no begin or end token is added. Its split is asked once for the class of
each code point met, and its normaliser for texts with code points that Python's
Unicode tables do not know. A vocabulary without a token for every byte is an
error when a text needs the missing one. A null or empty text has 0 bytes and 0
tokens; an empty table gives an empty result. Rows are counted one by one, equal
ones too, other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import hash_spans, slices

LIMIT = 2048
CHUNK = 128
#: Pre-tokens, and states, a task remembers before it starts anew.
CACHE_WORDS = 400_000
CACHE_STATES = 100_000
END_OF_WORD = "</w>"

SPACE, LETTER, NUMBER, MARK, SHORT, LONG, SPECIAL = range(7)
BETWEEN, LETTERS, MARKS, TWO_MORE, ONE_MORE = range(5)
#: The code point that stands for an added token.
ADDED = 0x110000
# fixed values: Unicode White_Space, and the contractions of the split pattern
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted pre-tokens, by state * 8 + class."""
    to, emit = np.zeros((5, 8), np.int8), np.zeros((5, 8), np.int8)
    for state in (BETWEEN, LETTERS, MARKS):
        to[state, [SPACE, NUMBER, SPECIAL]] = BETWEEN
        to[state, LETTER], to[state, MARK] = LETTERS, MARKS
        to[state, SHORT], to[state, LONG] = ONE_MORE, TWO_MORE
        emit[state, [LETTER, NUMBER, MARK, SHORT, LONG, SPECIAL]] = 1
    emit[LETTERS, LETTER] = 0
    to[MARKS, [SHORT, LONG]] = MARKS
    emit[MARKS, [MARK, SHORT, LONG]] = 0
    to[TWO_MORE], to[ONE_MORE] = ONE_MORE, BETWEEN
    return to.ravel(), emit.ravel()


class PreTokens:
    TO, EMIT = _machine()

    def __init__(self, splitter):
        self.splitter = splitter
        self.kind = np.full(ADDED + 1, -1, np.int8)
        self.kind[WHITE] = SPACE
        self.kind[ADDED] = SPECIAL

    def ask(self, cps: np.ndarray) -> None:
        """Learn the classes of code points from the library's own split, whose tables of
        characters may be newer than Python's: a letter joins letters, a mark joins marks, a
        number stands alone."""
        text = "".join(f" a{chr(c)}a !{chr(c)}!" for c in cps.tolist())
        begins = np.array([first for _, (first, _) in self.splitter.pre_tokenize_str(text)])
        n = np.bincount(begins // 4, minlength=2 * len(cps)).reshape(-1, 2)  # pieces of each group of four
        self.kind[cps] = np.where(n[:, 0] == 1, LETTER, np.where(n[:, 1] == 1, MARK, NUMBER))

    def classes(self, cps: np.ndarray) -> np.ndarray:
        seen = np.zeros(ADDED + 1, bool)
        seen[cps] = True
        new = np.flatnonzero(seen & (self.kind < 0))
        if len(new):
            self.ask(new)
        out = self.kind[cps]
        at = np.flatnonzero(cps == ord("'"))
        if len(at):
            ahead = np.r_[cps, 0, 0]
            one, two = ahead[at + 1], ahead[at + 2]
            short = np.isin(one, [ord(x) for x in CONTRACTIONS if len(x) == 1])
            long = np.zeros(len(at), bool)
            for x in CONTRACTIONS:
                if len(x) == 2:
                    long |= (one == ord(x[0])) & (two == ord(x[1]))
            out[at[short]], out[at[long]] = SHORT, LONG
        return out

    def emissions(self, classes: np.ndarray) -> np.ndarray:
        """Pre-tokens begun at each position, from the state between pre-tokens."""
        n = len(classes)
        m = -(-n // CHUNK)
        cut = np.zeros(m * CHUNK, np.int8)
        cut[:n] = classes
        steps = np.ascontiguousarray(cut.reshape(m, CHUNK).T)
        maps = np.tile(np.arange(5, dtype=np.int8), (m, 1))
        for c in steps:
            maps = self.TO[maps * 8 + c[:, None]]
        far = 1
        while far < m:  # prefix scan: each map takes in the 1, 2, 4, ... maps before it
            maps = np.concatenate([maps[:far], np.take_along_axis(maps[far:], maps[:-far].astype(np.int64), axis=1)])
            far *= 2
        state = np.r_[np.int8(BETWEEN), maps[:-1, BETWEEN]]
        out = np.empty_like(steps)
        for k, c in enumerate(steps):
            at = state * 8 + c
            out[k], state = self.EMIT[at], self.TO[at]
        return out.T.ravel()[:n]


class Merges:
    def __init__(self, vocab: dict[str, int], merges: list):
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): k for k, m in enumerate(merges)}
        self.symbol = self.byte_symbols()
        self.child: dict[tuple[int, str], int] = {}
        self.token: dict[int, tuple[str, ...]] = {}
        for text in vocab:
            final = text.endswith(END_OF_WORD) and len(text) > len(END_OF_WORD)
            chars = list(text[:-len(END_OF_WORD)] if final else text)
            if final:
                chars[-1] += END_OF_WORD
            node = 0
            for c in chars:
                node = self.child.setdefault((node, c), len(self.child) + 1)
            self.token[node] = tuple(chars)
        self.follows: dict[tuple[int, int], bool] = {}
        self.clear()

    @staticmethod
    def byte_symbols() -> list[str]:
        """Printable stand-in of each byte: itself where printable, else from U+0100 on."""
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]

    def clear(self):
        self.states: dict[tuple, int] = {}
        self.parts: list[tuple] = []
        self.steps: dict[int, tuple[int, int]] = {}
        self.lasts: dict[int, int] = {}
        self.start = self.state((-1, ()))

    def state(self, key: tuple) -> int:
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = len(self.parts)
            self.parts.append(key)
        return found

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair merging, lowest rank first."""
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, k = [], 0
            while k < len(symbols):
                if k + 1 < len(symbols) and (symbols[k], symbols[k + 1]) == best:
                    out.append(best[0] + best[1])
                    k += 2
                else:
                    out.append(symbols[k])
                    k += 1
            symbols = out
        return symbols

    def may_follow(self, before: int, node: int) -> bool:
        """Whether merging leaves the two tokens (or, at a word's begin, the one) as they are."""
        found = self.follows.get((before, node))
        if found is None:
            first = self.token[before] if before >= 0 else ()
            own = ["".join(first), "".join(self.token[node])] if first else ["".join(self.token[node])]
            found = self.follows[before, node] = self.merged([*first, *self.token[node]]) == own
        return found

    def reached(self, parts: tuple, symbol: str):
        """Suffixes that go on with ``symbol``, and the (token, count) they give the prefix."""
        last, open_ = parts
        grown = [(self.child[node, symbol], before, n) for node, before, n in (*open_, (0, last, 0)) if (node, symbol) in self.child]
        for node, before, n in grown:
            if node in self.token and self.may_follow(before, node):
                return grown, node, n + 1
        raise ValueError(f"the vocabulary has no token for {symbol!r}")

    def step(self, state: int, byte: int) -> tuple[int, int]:
        grown, last, n = self.reached(self.parts[state], self.symbol[byte])
        out = self.steps[state << 8 | byte] = self.state((last, tuple((node, before, k - n) for node, before, k in grown))), n
        return out

    def last(self, state: int, byte: int) -> int:
        out = self.lasts[state << 8 | byte] = self.reached(self.parts[state], self.symbol[byte] + END_OF_WORD)[2]
        return out

    def count(self, word: bytes) -> int:
        """Tokens of a pre-token: the sum of what its transitions emit."""
        state, total, steps = self.start, 0, self.steps
        for b in word[:-1]:
            found = steps.get(state << 8 | b)
            state, n = found if found is not None else self.step(state, b)
            total += n
        key = state << 8 | word[-1]
        n = self.lasts.get(key)
        return total + (n if n is not None else self.last(state, word[-1]))


class Counter:
    """Token counts of batches of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"])
        library = Tokenizer.from_file(path)
        self.pre, self.normalizer = PreTokens(library.pre_tokenizer), library.normalizer
        #: Code points that Python's tables do not know: the library may lower or compose them.
        self.unknown = np.zeros(ADDED + 1, bool)
        self.asked = np.zeros(ADDED + 1, bool)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.known: dict[int, int] = {}

    def read(self, text: str) -> np.ndarray:
        """Normalised code points; an added token is one symbol."""
        parts = self.split.split(text) if self.split and any(a in text for a in self.added) else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([ADDED], np.int32))
            else:  # a lone lower-case sigma for every capital one: letters are lowered one by one
                own = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                cps = np.frombuffer(own.encode("utf-32-le"), "<i4")
                if len(cps) and int(cps.max()) > 0x7F and self.has_unknown(cps):
                    cps = np.frombuffer(self.normalizer.normalize_str(part).encode("utf-32-le"), "<i4")
                out.append(cps)
        return np.concatenate(out) if len(out) > 1 else out[0]

    def has_unknown(self, cps: np.ndarray) -> bool:
        """Whether a code point is not assigned in Python's tables."""
        new = cps[~self.asked[cps]]
        if len(new):
            new = np.unique(new)
            self.asked[new] = True
            self.unknown[new] = [unicodedata.category(chr(c)) == "Cn" for c in new.tolist()]
        return bool(self.unknown[cps].any())

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        if len(self.merges.parts) > CACHE_STATES:
            self.merges.clear()
        if len(self.merges.follows) > CACHE_WORDS:
            self.merges.follows.clear()
        line = np.array([10], np.int32)
        read = [self.read(t or "") for t in texts]
        first = np.cumsum([0] + [len(x) + 1 for x in read])
        cps = np.concatenate([x for r in read for x in (r, line)])
        classes = self.pre.classes(cps)
        begin = self.pre.emissions(classes) > 0
        edges = np.flatnonzero(begin | (classes == SPACE) | (classes == SPECIAL))
        own = begin[edges]
        starts, ends = edges[own], np.r_[edges[1:], len(cps)][own]
        row = np.searchsorted(first, starts, side="right") - 1
        counts = np.ones(len(starts), np.int64)
        word = np.flatnonzero(classes[starts] != SPECIAL)
        raw = np.ascontiguousarray(cps).view(np.uint8)
        h, at, which = np.unique(hash_spans(raw, starts[word] * 4, ends[word] * 4), return_index=True, return_inverse=True)
        n = np.fromiter((self.known.get(x, 0) for x in h.tolist()), np.int64, len(h))
        new = np.flatnonzero(n == 0)
        for k, a, b in zip(new.tolist(), starts[word[at[new]]].tolist(), ends[word[at[new]]].tolist(), strict=True):
            n[k] = self.merges.count(cps[a:b].tobytes().decode("utf-32-le").encode())
        self.known.update(zip(h[new].tolist(), n[new].tolist(), strict=True))
        counts[word] = n[which]
        return np.bincount(row, weights=counts, minlength=len(texts)).astype(np.int64)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit. ``path`` is the vocabulary file,
    at the same place on every executor."""

    def run(batches):
        counter = Counter(path)
        for b in batches:
            for first, end in slices(b.column(1), 4 << 20):
                texts = b.column(1).slice(first, end - first)
                n = counter(texts.to_pylist())
                size = pc.coalesce(pc.binary_length(texts), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), size, pa.array(n), pa.array(n > limit)],
                                                 names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
