"""Token counts by finite-state transducers that are compiled from a tokenizer's file.

Two deterministic transducers make the count.  The first reads characters and emits where pieces begin; it has few
states, so that a stretch of text is a map from state to state.  Texts are cut into chunks of equal length, all chunks'
maps are worked out side by side and composed by a parallel prefix scan, which gives each chunk the state it begins in.
The second reads a piece's bytes.  Its states are the ways in which the last tokens of the piece so far can go on, found
when first needed; its transitions are annotated with the tokens that a byte adds to the count, or takes back.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import arrow_batches

#: Tokens that a document may have.
LIMIT = 2048
#: Characters of a chunk, whose map from state to state is worked out at one go.
CHUNK = 64
#: Characters handled at a time; a longer text is cut before a blank, where no piece and no composition goes on.
RUN_CHARS = 1 << 20
_BLANK = re.compile("[ \t\n\r\u3000]")
#: Transitions of the byte transducer, and counted pieces, that a task keeps; beyond that it starts to collect them anew.
TRANSITIONS, PIECES = 1 << 19, 1 << 18

#: Classes of characters.  The letters that contractions hold are classes of their own, after these.
SPACE, NUMBER, OTHER, LETTER, FIRST_OWN = 0, 1, 2, 3, 4
#: Marks a special token; no text can hold it.
SPECIAL = "\ud800"
#: Set with the class of a character whose normal form may depend on its neighbours or has several characters.
COMPLEX = 0x80
#: A pattern of pieces: contractions, then runs of letters, single numbers, runs of anything else.
_PIECES = re.compile(r"((?:'[a-z]+\|)*)\[\\p\{L\}\]\+\|\[\\p\{N\}\]\|\[\^\\s\\p\{L\}\\p\{N\}\]\+")


class BytePairs:
    """The byte transducer of a merge list, with a mark on the last byte of a piece."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        letter = _byte_letters()
        self.first = [vocab[letter[b]] for b in range(256)] + [vocab[letter[b] + end] for b in range(256)]
        self.ranks = {}
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.symbols: dict[int, tuple[int, ...]] = {}
        for s, t in enumerate(self.first):
            self.symbols[t] = (s,)
        # A token's symbols are those of the pair it is merged from; merges come after what they merge.
        for (a, b), (_, t) in self.ranks.items():
            self.symbols[t] = self.symbols[a] + self.symbols[b]
        self.child: dict[int, int] = {}
        self.token = [-1]
        for t, symbols in self.symbols.items():
            node = 0
            for s in symbols:
                at = node << 9 | s
                if at not in self.child:
                    self.child[at] = len(self.token)
                    self.token.append(-1)
                node = self.child[at]
            self.token[node] = t
        self.follows: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.numbers = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.follows.clear()
        self.counts: dict[bytes, int] = {}

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """The tokens of a piece by its merges, the lowest rank first and the leftmost of equal ones."""
        own = [self.first[s] for s in symbols]
        while len(own) > 1:
            best = min(((self.ranks[p][0], i) for i, p in enumerate(zip(own, own[1:])) if p in self.ranks), default=None)
            if best is None:
                break
            i = best[1]
            own[i : i + 2] = [self.ranks[own[i], own[i + 1]][1]]
        return own

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether b can stand after a (-1: nothing) in the tokens of a piece: merging both texts gives back just them."""
        known = self.follows.get((a, b))
        if known is None:
            symbols = self.symbols[b] if a < 0 else self.symbols[a] + self.symbols[b]
            known = self.follows[a, b] = self.merged(symbols) == ([b] if a < 0 else [a, b])
        return known

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        """The state after a byte, and how the number of tokens changes with it.

        A state holds (node, last, since) for each place behind which a token may have begun: the node that the bytes
        since then reach in the tree of all tokens, the last token before it, and how many tokens the bytes since then make.
        The tokens of what was read so far end with the one token that may follow the one before it.
        """
        open_, found = [], None
        for node, last, since in self.states[state]:
            after = self.child.get(node << 9 | symbol)
            if after is None:
                continue
            open_.append((after, last, since))
            t = self.token[after]
            if found is None and t >= 0 and self._may_follow(last, t):
                found = t, since
        token, since = found
        change = 1 - since
        own = (*((node, last, n + change) for node, last, n in open_), (0, token, 0))
        if own not in self.numbers:
            self.numbers[own] = len(self.states)
            self.states.append(own)
        return self.numbers[own], change

    def count(self, piece: bytes) -> int:
        """Tokens of a piece; its last byte is read with the mark of the end."""
        known = self.counts.get(piece)
        if known is not None:
            return known
        if len(self.steps) > TRANSITIONS:
            self._reset()
        steps, state, total = self.steps, 0, 0
        last = len(piece) - 1
        for i, symbol in enumerate(piece):
            at = state << 9 | (symbol if i < last else symbol + 256)
            step = steps.get(at)
            if step is None:
                step = steps[at] = self._step(state, at & 511)
            state, change = step
            total += change
        if len(self.counts) >= PIECES:
            self.counts.clear()
        self.counts[piece] = total
        return total


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary: the byte's own where that can be seen, else the next from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)]


class Pieces:
    """The character transducer: from state and class to state and marks (1: a piece begins here, 2: it began one before).

    States are: between pieces, in letters, in other signs, and the beginnings of contractions, which only the next
    character settles.  Classes from `width` on are those of a row's first character, where any state ends.
    """

    BETWEEN, LETTERS, SIGNS = 0, 1, 2

    def __init__(self, contractions: list[str]):
        self.own = sorted(set("".join(contractions)))
        begun = sorted({c[:n] for c in contractions for n in range(1, len(c))}, key=lambda x: (len(x), x))
        if any(len(c) > 3 or c[0] != "'" for c in contractions):
            raise ValueError("contractions are an apostrophe and one or two letters")
        names = ["", "L", "O", *begun]
        self.n, self.width = len(names), FIRST_OWN + len(self.own)
        self.next = np.zeros((self.n, 2 * self.width), dtype=np.uint8)
        self.marks = np.zeros((self.n, 2 * self.width), dtype=np.uint8)
        for s, name in enumerate(names):
            for c in range(2 * self.width):
                if c < self.width:
                    self.next[s, c], self.marks[s, c] = self._go(s, names, contractions, c)
                else:
                    to, marks = self._go(self.BETWEEN, names, contractions, c - self.width)
                    self.next[s, c], self.marks[s, c] = to, marks | (2 if s > 2 and len(name) > 1 else 0)

    def _go(self, s: int, names: list[str], contractions: list[str], c: int) -> tuple[int, int]:
        sign = self.own[c - FIRST_OWN] if c >= FIRST_OWN else ""
        before = 0
        if s > 2:
            grown = names[s] + sign
            if sign and grown in contractions:
                return self.BETWEEN, 0
            if sign and grown in names:
                return names.index(grown), 0
            # No contraction: the apostrophe was a sign, and a letter after it began a run of letters.
            s, before = (self.LETTERS, 2) if len(names[s]) > 1 else (self.SIGNS, 0)
        if c == SPACE:
            return self.BETWEEN, before
        if c == NUMBER:
            return self.BETWEEN, before | 1
        if c == OTHER or sign == "'":
            if s == self.SIGNS:
                return s, before
            return (names.index("'") if sign and "'" in names else self.SIGNS), before | 1
        return self.LETTERS, before | (s != self.LETTERS)

    def begins(self, classes: np.ndarray) -> np.ndarray:
        """Where pieces begin; the last class must be SPACE, so that nothing stays open."""
        n, wide = len(classes), 2 * self.width
        rows = -(-n // CHUNK)
        grid = np.zeros(rows * CHUNK, dtype=np.intp)
        grid[:n] = classes
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        to, marks = (self.next.astype(np.intp) * wide).ravel(), self.marks.ravel()
        # Every chunk's map from the state before it to the state after it, all chunks side by side.
        maps = np.tile(np.arange(self.n, dtype=np.intp) * wide, (rows, 1))
        for column in grid:
            maps = to[maps + column[:, None]]
        # Prefix scan: after each round a chunk's map covers twice as many chunks.
        maps //= wide
        reach = 1
        while reach < rows:
            maps = np.concatenate([maps[:reach], np.take_along_axis(maps[reach:], maps[:-reach], axis=1)])
            reach *= 2
        state = np.zeros(rows, dtype=np.intp)
        state[1:] = maps[:-1, self.BETWEEN] * wide
        out = np.empty((CHUNK, rows), dtype=np.uint8)
        for k, column in enumerate(grid):
            at = state + column
            out[k], state = marks[at], to[at]
        flat = out.T.ravel()
        here = (flat & 1).astype(bool)
        here[:-1] |= (flat[1:] & 2).astype(bool)
        return here[:n]


@dataclass
class Compiled:
    """What a tokenizer's file is compiled to; its size depends on the vocabulary and Unicode alone."""

    vocab: dict[str, int]
    merges: list
    end: str
    normalizer: str
    pieces: Pieces
    specials: list[str]
    classes: np.ndarray
    lower: np.ndarray
    _live: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "_live": {}}

    @property
    def byte_pairs(self) -> BytePairs:
        """Made by each task's worker, with the states it meets."""
        if "pairs" not in self._live:
            self._live["pairs"] = BytePairs(self.vocab, self.merges, self.end)
        return self._live["pairs"]

    def normal(self, text: str) -> str:
        if "normalizer" not in self._live:
            self._live["normalizer"] = _part(normalizer=json.loads(self.normalizer)).normalizer
        return self._live["normalizer"].normalize_str(text)


def _part(**parts):
    """A tokenizer of the library with some parts of another and no words."""
    from tokenizers import Tokenizer

    return Tokenizer.from_str(json.dumps({"version": "1.0", "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}, **parts}))


def _composing() -> set[str]:
    """Characters that composition may join to what stands before them."""
    found = {chr(c) for lo, hi in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(lo, hi)}
    for c in range(0x30000):
        parts = unicodedata.decomposition(chr(c))
        if parts and parts[0] != "<":
            found.update(chr(int(x, 16)) for x in parts.split()[1:])
    return found


def compiled(path: str) -> Compiled:
    """Compiles a tokenizer file of byte pairs over pieces with marked ends; its normal form and pieces are asked of the library.

    Every character's class and lower-case form are taken from what the library makes of it, so that both agree on all
    of Unicode.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, splits = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    pattern = _PIECES.fullmatch(splits[0].get("pattern", {}).get("Regex", "")) if splits else None
    plain = model["type"] == "BPE" and model["end_of_word_suffix"] and not model["ignore_merges"] and not model["dropout"]
    if not plain or not pattern or [x["type"] for x in splits] != ["Split", "ByteLevel"] or splits[1]["use_regex"]:
        raise ValueError(f"{path} is no tokenizer of byte pairs over letters, numbers and signs")
    pieces = Pieces([x for x in pattern[1].split("|") if x])
    normal, split = _part(normalizer=spec["normalizer"]).normalizer, _part(pre_tokenizer={"type": "Sequence", "pretokenizers": splits[:1]}).pre_tokenizer
    classes = np.full(0x110000, OTHER | COMPLEX, dtype=np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    # Beyond these planes there are no letters; private and unassigned characters are signs.
    asked = [c for c in (*range(1, 0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE1000)) if c < 0x20000 or unicodedata.category(chr(c)) != "Cn"]
    forms = normal.normalize_str("\0".join(map(chr, asked))).split("\0")
    joins = _composing()
    simple = [(c, ord(x)) for c, x in zip(asked, forms) if len(x) == 1]
    simple.append((0, 0))
    points = [x for _, x in simple]
    for before, longer, shorter in (("a", LETTER, None), ("1", None, SPACE), (".", OTHER, None)):
        text = " ".join(before + chr(x) for x in points)
        ends = np.zeros(len(text) + 1, dtype=np.int64)
        starts = np.zeros(len(text) + 1, dtype=bool)
        for _, (s, e) in split.pre_tokenize_str(text):
            ends[s] = e
            starts[s] = True
        at = np.arange(len(points)) * 3
        if longer is not None:
            own = ends[at] == at + 2
            value = longer
        else:
            own, value = ~starts[at + 1], shorter
        if before == "a":
            kind = np.where(own, value, NUMBER)
        else:
            kind[own] = value
    for (c, x), k in zip(simple, kind.tolist()):
        lower[c] = x
        one = chr(c)
        alone = unicodedata.category(one) != "Cn" and unicodedata.combining(one) == 0 and one not in joins and unicodedata.is_normalized("NFC", one)
        sign = chr(x)
        k = FIRST_OWN + pieces.own.index(sign) if sign in pieces.own else k
        classes[c] = k if alone else k | COMPLEX
    classes[ord(SPECIAL)] = SPACE
    specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} has special tokens that are more than their text")
    return Compiled(model["vocab"], model["merges"], model["end_of_word_suffix"], json.dumps(spec["normalizer"]), pieces, specials, classes, lower)


def _parts(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and texts of about RUN_CHARS characters; a longer text is cut before blanks."""
    rows, own, chars = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > RUN_CHARS:
                blank = _BLANK.search(text, at + RUN_CHARS)
                end = blank.start() if blank else end
            rows.append(row)
            own.append(text[at:end] if at or end < len(text) else text)
            chars += end - at
            at = end
            if chars >= RUN_CHARS:
                yield rows, own
                rows, own, chars = [], [], 0
    if own:
        yield rows, own


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def counted(texts: list[str], c: Compiled) -> np.ndarray:
    """Tokens of each text, as the library counts them."""
    total = np.zeros(len(texts), dtype=np.int64)
    special = re.compile("|".join(map(re.escape, c.specials))) if c.specials else None
    for rows, own in _parts(texts):
        if special:
            for i, text in enumerate(own):
                if special.search(text):
                    # What stands between special tokens is brought into normal form apart.
                    between = special.split(text)
                    total[rows[i]] += len(between) - 1
                    own[i] = SPECIAL.join(c.normal(x) for x in between)
        codes = _codes(own)
        lengths = np.array([len(x) for x in own], dtype=np.int64)
        complex_ = c.classes[codes] & COMPLEX
        if complex_.any():
            first = np.cumsum(lengths) - lengths
            for i in np.unique(np.searchsorted(first + lengths, np.flatnonzero(complex_), side="right")).tolist():
                own[i] = SPECIAL.join(c.normal(x) for x in own[i].split(SPECIAL))
            codes = _codes(own)
            lengths = np.array([len(x) for x in own], dtype=np.int64)
        classes = np.append(c.classes[codes] & (COMPLEX - 1), SPACE).astype(np.intp)
        firsts = (np.cumsum(lengths) - lengths)[lengths > 0]
        classes[firsts] += c.pieces.width
        begins = c.pieces.begins(classes)[:-1]
        classes[firsts] -= c.pieces.width
        kept = classes[:-1] != SPACE
        if not kept.any():
            continue
        begins = begins[kept]
        low = c.lower[codes[kept]]
        widths = 1 + (low > 0x7F).astype(np.int64) + (low > 0x7FF) + (low > 0xFFFF)
        ends = np.cumsum(widths)
        data = low.tobytes().decode("utf-32-le").encode()
        offsets = np.append(ends[begins] - widths[begins], len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        each = np.fromiter(map(c.byte_pairs.count, pieces.dictionary.to_pylist()), np.int64, len(pieces.dictionary))[pieces.indices.to_numpy()]
        row_of = np.repeat(np.array(rows), lengths)[kept][begins]
        np.add.at(total, row_of, each)
    return total


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of `docs`, by the tokenizer in the file `path`.

    The driver compiles the file and broadcasts the tables, some 10 MB that depend on the vocabulary and Unicode alone;
    executors need the file no more.  Documents are counted where they are read, without a shuffle; a text of any length
    is counted whole.  Null and empty texts have no bytes and no tokens.  Repeated rows and null ids are counted one by
    one, other columns are ignored, and no rows give none.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(compiled(path))

    def count(batches):
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            n = counted(text.to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.binary_length(text).cast(pa.int64()), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
