"""Token counts of a byte-level pair-merge vocabulary by finite-state transducers.

Two deterministic transducers, compiled from the vocabulary file:

* :class:`Splitter` cuts a text into the pieces that are merged apart from each other. It has
  eight states. A chunk of text is a map from state to state; the maps of all chunks are found
  side by side, composed by a parallel prefix scan, and each chunk is then run once from the
  state the scan gives it. A separator leads every state to the start, so that many texts are
  scanned as one.
* :class:`PieceCounter` reads the bytes of a piece. Its transitions carry the change of the
  number of tokens, so that a piece's tokens are the sum along its path. A state holds the
  suffixes that may still grow into a token, with the token before each and its number, which
  is all that the later merges depend on. States are made when first reached.

Counts equal those of the library for the file; ``tests/llm`` compares them on random texts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import broadcast

SEPARATOR = "\ud800"  # no text holds a lone surrogate

# Classes of characters; the last three come from looking ahead.
LETTER, NUMBER, OTHER, BLANK, SPACE, BREAK, LAST_BLANK, SHORT, LONG = range(9)
N_SYMBOLS = 9
# States: a new piece begins; in letters, numbers, others, blanks; after a piece's leading
# space; one or two more letters of a contraction.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, LED, ONE_MORE, TWO_MORE = range(8)
N_STATES = 8


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece begins here) by state and symbol.

    BLANK: white space before white space or the end. SPACE: a plain space before anything
    else, which leads the next piece. LAST_BLANK: other white space before anything else.
    SHORT, LONG: an apostrophe before a contraction of one or two letters.
    """
    own = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, BLANK: IN_BLANKS, SPACE: LED,
           BREAK: START, LAST_BLANK: START, SHORT: ONE_MORE, LONG: TWO_MORE}
    goes = np.array([[own[s] for s in range(N_SYMBOLS)]] * N_STATES, np.int64)
    begins = np.ones((N_STATES, N_SYMBOLS), bool)

    def stay(state: int, symbol: int, to: int) -> None:
        goes[state, symbol], begins[state, symbol] = to, False

    stay(IN_LETTERS, LETTER, IN_LETTERS)
    stay(IN_NUMBERS, NUMBER, IN_NUMBERS)
    stay(IN_BLANKS, BLANK, IN_BLANKS)
    for symbol in (OTHER, SHORT, LONG):
        stay(IN_OTHERS, symbol, IN_OTHERS)
        stay(LED, symbol, IN_OTHERS)
    stay(LED, LETTER, IN_LETTERS)
    stay(LED, NUMBER, IN_NUMBERS)
    stay(ONE_MORE, LETTER, START)
    stay(TWO_MORE, LETTER, ONE_MORE)
    return goes, begins


class Splitter:
    def __init__(self, classes: np.ndarray, width: int = 512):
        self.classes, self.width = classes, width
        goes, begins = transitions()
        self.goes, self.begins = goes.ravel(), begins.ravel()

    def symbols(self, points: np.ndarray) -> np.ndarray:
        kind = self.classes[points].astype(np.int64)
        after = np.append(kind[1:], BREAK)
        blank, ends = (kind == BLANK) | (kind == SPACE), (after == BLANK) | (after == SPACE) | (after == BREAK)
        out = np.where(blank, np.where(ends, BLANK, np.where(kind == SPACE, SPACE, LAST_BLANK)), kind)
        quotes = np.flatnonzero(points == ord("'"))
        if len(quotes):
            ahead = np.append(points, [0, 0])
            a, b = ahead[quotes + 1], ahead[quotes + 2]
            out[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
            two = (a << 8) + b
            out[quotes[np.isin(two, [(ord(x) << 8) + ord(y) for x, y in ("re", "ve", "ll")])]] = LONG
        return out

    def starts(self, points: np.ndarray) -> np.ndarray:
        """Where pieces begin in the code points; separators begin one too."""
        n, width = len(points), self.width
        chunks = -(-n // width)
        symbols = np.full(chunks * width, BREAK, np.int64)
        symbols[:n] = self.symbols(points)
        columns = np.ascontiguousarray(symbols.reshape(chunks, width).T)
        maps = np.tile(np.arange(N_STATES), (chunks, 1))  # each chunk's map of states
        for column in columns:
            maps = self.goes[maps * N_SYMBOLS + column[:, None]]
        far = 1
        while far < chunks:  # prefix scan: the map of chunk i becomes that of chunks 0 to i
            maps[far:] = np.take_along_axis(maps[far:], maps[:-far], axis=1)
            far *= 2
        state = np.append(START, maps[:-1, START])
        flags = np.empty((width, chunks), bool)
        for i, column in enumerate(columns):
            at = state * N_SYMBOLS + column
            flags[i], state = self.begins[at], self.goes[at]
        return np.flatnonzero(flags.T.ravel()[:n])


class PieceCounter(dict):
    """Tokens of a piece (text); a dict of the pieces counted, emptied at ``limit`` of them."""

    def __init__(
        self, vocabulary: set[bytes], ranks: dict[tuple[bytes, bytes], int], limit: int = 400_000, states: int = 400_000
    ):
        super().__init__()
        self.vocabulary, self.ranks, self.limit, self.most = vocabulary, ranks, limit, states
        self.prefixes = {t[:i] for t in vocabulary for i in range(len(t))}
        # The merges that made a token, along its left and its right edge: what stands there
        # until which merge.
        halves = {a + b: (a, b, rank) for (a, b), rank in sorted(ranks.items(), key=lambda x: -x[1])}
        self.left, self.right = edges(halves, vocabulary, 0), edges(halves, vocabulary, 1)
        self.renew()

    def renew(self) -> None:
        start = ((b"", None, 0),)
        self.states, self.keys, self.out = {start: 0}, [start], [{}]
        self.valid: dict[tuple[bytes | None, bytes], bool] = {}

    def merged(self, word: bytes) -> list[bytes]:
        """The tokens of a byte string by repeated merges of the best pair."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(self.ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:]))
            if best == 1 << 60:
                break
            joined, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and self.ranks.get((parts[i], parts[i + 1])) == best:
                    joined.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        return parts

    def follows(self, before: bytes | None, token: bytes) -> bool:
        """Whether the token can stand after ``before`` (None: at the start) in a result."""
        key = (before, token)
        known = self.valid.get(key)
        if known is None:
            if len(self.valid) > 2 * self.most:
                self.valid.clear()
            known = self.valid[key] = self.merged(token) == [token] if before is None else self.keeps(before, token)
        return known

    def keeps(self, before: bytes, token: bytes) -> bool:
        """Whether no merge ever joins what stands on both sides of the tokens' border.

        At any time an edge token of either side stands there, from the merge that made it to
        the one that takes it up; a pair merges if its turn comes while both stand.
        """
        for a, a_made, a_taken in self.right[before]:
            for b, b_made, b_taken in self.left[token]:
                turn = self.ranks.get((a, b))
                # Equal pairs merge from the left, so the left side's own merge comes first.
                if turn is not None and a_made < turn < a_taken and b_made < turn <= b_taken:
                    return False
        return True

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition (next state, change of the number of tokens) on a byte."""
        added, last, change = bytes([byte]), None, 0
        for suffix, before, n in self.keys[state]:  # from the longest suffix
            token = suffix + added
            if token in self.vocabulary and self.follows(None, token) and (before is None or self.follows(before, token)):
                last, change = token, n + 1
                break
        if last is None:
            raise ValueError(f"no token ends at byte {byte:#x}: the vocabulary lacks single bytes")
        grown = tuple(
            (s + added, before, n - change) for s, before, n in self.keys[state] if s + added in self.prefixes
        )
        key = (*grown, (b"", last, 0))
        if key not in self.states:
            self.states[key] = len(self.keys)
            self.keys.append(key)
            self.out.append({})
        self.out[state][byte] = found = (self.states[key], change)
        return found

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        if piece == SEPARATOR:
            return 0
        if len(self.keys) > self.most:
            self.renew()
        state = total = 0
        out = self.out
        for byte in piece.encode():
            state, change = out[state].get(byte) or self.compile(state, byte)
            total += change
        self[piece] = total
        return total


def edges(halves: dict, vocabulary: set[bytes], side: int) -> dict[bytes, list[tuple[bytes, int, int]]]:
    """For each token, the (token, made by, taken by) along its left (0) or right (1) edge."""
    out: dict[bytes, list[tuple[bytes, int, int]]] = {}
    for token in vocabulary:
        part, taken, line = token, 1 << 60, []
        while part in halves:
            half = halves[part]
            line.append((part, half[2], taken))
            part, taken = half[side], half[2]
        line.append((part, -1, taken))
        out[token] = line
    return out


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def compiled(path: str) -> tuple[PieceCounter, tuple[str, ...]]:
    """(piece transducer, special strings) of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in (
        "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges", "dropout"))
    if not plain or spec["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
        raise ValueError(f"{path}: only plain byte-level pair-merge files can be compiled")
    special = [t for t in spec["added_tokens"]]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
        raise ValueError(f"{path}: special tokens that take blanks or whole words are not supported")
    alphabet = byte_alphabet()
    raw = {t: bytes(alphabet[c] for c in t) for t in model["vocab"] if all(c in alphabet for c in t)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ranks = {(raw[a], raw[b]): i for i, (a, b) in enumerate(pairs)}
    strings = tuple(t["content"] for t in special)
    return PieceCounter(set(raw.values()), ranks), strings


@lru_cache(maxsize=2)
def character_classes(path: str) -> np.ndarray:
    """The class of every code point, read off the tokenizer's own cutting of probe strings."""
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    out = np.full(0x110000, OTHER, np.uint8)

    def begins(points: np.ndarray, lead: str, end: str) -> np.ndarray:
        """Where pieces begin in lines of the lead, the character and the end."""
        text = "".join(f"{lead}{chr(c)}{end}\n" for c in points)
        flags = np.zeros(4 * len(points), bool)
        flags[[a for _, (a, _) in cut(text)]] = True
        return flags.reshape(-1, 4)

    # Planes 4 to 13 are unassigned and 15 and 16 private: neither letters nor numbers.
    for low in [*range(0, 0x40000, 0x8000), 0xE0000]:
        points = np.array([c for c in range(low, low + 0x8000) if not 0xD800 <= c < 0xE000], np.int64)
        flags = begins(points, "a", "1")
        out[points[~flags[:, 1]]] = LETTER
        out[points[flags[:, 1] & ~flags[:, 2]]] = NUMBER
        rest = points[flags[:, 1] & flags[:, 2]]
        out[rest[begins(rest, "!", "!")[:, 2]]] = BLANK
    out[ord(" ")] = SPACE
    out[0xD800] = BREAK
    return out


class TokenCounter:
    """Token counts of texts, some ``chunk`` characters at a time."""

    def __init__(self, path: str, classes: np.ndarray, chunk: int = 1_000_000):
        self.pieces, self.special = compiled(path)
        self.splitter, self.chunk = Splitter(classes), chunk

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        held, at, size = [], [], 0
        for i, text in enumerate(texts):
            for j, part in enumerate(self.parts(text)):
                out[i] += j > 0
                held.append(part)
                at.append(i)
                size += len(part) + 1
            if size >= self.chunk or i + 1 == len(texts):
                np.add.at(out, at, self.scan(held))
                held, at, size = [], [], 0
        return out

    def parts(self, text: str) -> list[str]:
        parts = [text]
        for s in self.special:
            parts = [x for p in parts for x in p.split(s)]
        return parts

    def scan(self, texts: list[str]) -> np.ndarray:
        whole = SEPARATOR.join(["", *texts])  # every text follows a separator
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = self.splitter.starts(points)
        cuts = starts.tolist()
        counted = map(self.pieces.__getitem__, [whole[a:b] for a, b in zip(cuts, [*cuts[1:], len(whole)])])
        total = np.fromiter(counted, np.int64, len(cuts))
        return np.add.reduceat(total, np.flatnonzero(points[starts] == 0xD800))


def token_counts(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` packed in ``doc``, with ``n_bytes``, the tokens of the whole text and whether they exceed ``limit``.

    A null text counts as empty: no bytes, no tokens. Every row is counted by itself, so
    repeated rows and ties do not matter; an empty table gives no rows. ``path`` is read on
    the executors: the file must be there, as an installed package is.
    """
    classes = broadcast(docs.sparkSession, character_classes(path))
    rest = [c for c in docs.columns if c != text]
    lines = docs.select(F.struct(*rest).alias("doc"), F.col(text).cast("string").alias("text"))
    schema = lines.select("doc").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path, classes.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), sizes, pa.array(counter.count(texts), pa.int64())],
                    names=["doc", "n_bytes", "n_tokens"],
                )

    counted = lines.mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
