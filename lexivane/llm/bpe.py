"""BPE encoding and decoding by tree concatenation.

Two kinds of text are cut in halves down to short leaves, which are encoded in parallel
(all leaves of a batch by one vectorised call, batches by tasks) and joined level by level:

- Whole texts are halved wherever the middle falls, as long as both halves have white
  space. At a join a window of whole runs between spaces or line ends around the cut is
  encoded again, and grows until its first and last token are those that the halves have
  there; the tokens between are replaced. A token never crosses a space or line end, so
  what lies beyond the window stands.
- A long pre-token (a run's part that the pre-tokenizer doesn't split) has no such places.
  Its symbols are halved, leaves go to the library's merge engine, and the tokens in a
  window around the join are merged again until the window's ends agree. Two token
  sequences are then valid in every adjacent pair, which makes their concatenation the BPE
  encoding of the whole.

Runs are encoded on their own and their results are kept in a bounded per-worker cache.

Defined results: null text and empty text have no ids and decode to the empty string;
strings of special tokens become their ids, as in the library; null ids decode to the
empty string; all other columns of the input are kept, whatever their names, and a new
column whose name is taken gets underscores in front.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexivane.llm.common import bounded_batches, free_name, tidied

LEAF = 64
WINDOW = 4
#: A longer text, in characters, is halved.
TEXT_LEAF = 512
CACHE_WORDS = 120_000
#: Without the tree, which holds more of a batch besides: about 150 MB more.
PLAIN_CACHE_WORDS = 700_000
LONG_WORD = 64


class TreeBpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW, tree: bool = True, text_leaf: int = TEXT_LEAF, cache: int = CACHE_WORDS):
        """tree=False leaves texts whole, and pre-tokens, however long, to the library's own model."""
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.leaf, self.window, self.text_leaf, self.cache = leaf, window, text_leaf, cache
        self.joins = self.grown = 0
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        # A symbol that ends a word gets a character of its own, so that the merge engine needs no suffix and any slice of a word can be encoded.
        bases = [k for k in vocab if self.suffix and k.endswith(self.suffix) and len(k) == len(self.suffix) + 1]
        self.ending = {k[0]: chr(0xF0000 + i) for i, k in enumerate(sorted(bases))}

        def inner(token: str) -> str:
            if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
                head = token[: -len(self.suffix)]
                return head[:-1] + self.ending[head[-1]] if head[-1] in self.ending else token
            return token

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        inside = {inner(k): v for k, v in vocab.items()}
        self.engine = Tokenizer(BPE(vocab=inside, merges=[(inner(a), inner(b)) for a, b in merges]))
        self.engine.encode_special_tokens = True
        self.strings: dict[int, str] = {v: k for k, v in vocab.items()}
        self.lengths = {v: len(k) for k, v in inside.items()}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.strings |= {i: s for s, i in self.special.items()}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.all_ids = pa.array(sorted(self.strings), pa.int32())
        self.names = pa.array([self.strings.get(i, "") for i in range(max(self.strings) + 1)], pa.string())
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.id_bytes = {i: i.to_bytes(4, "little") for i in self.strings}
        self.tree = tree
        self.tokenize = self.engine.model.tokenize if tree else library.model.tokenize
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.byte_symbols = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        patterns = [p["pattern"]["Regex"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
        self.latin = regex.compile(patterns[0])

    # ---- pieces -------------------------------------------------------------------
    def _engine_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.engine.encode_batch(texts, add_special_tokens=False)]

    def _slice_of(self, symbols: str, ids: list[int], k: int, tail: bool) -> str:
        part = ids[-k:] if tail else ids[:k]
        n = sum(self.lengths[i] for i in part)
        return symbols[len(symbols) - n :] if tail else symbols[:n]

    def join(self, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
        """Concatenate two encoded strings of symbols exactly."""
        (a, x), (b, y) = left, right
        if not x or not y:
            return a + b, x or y
        k = self.window
        while True:
            kx, ky = min(k, len(x)), min(k, len(y))
            middle = self._slice_of(a, x, kx, True) + self._slice_of(b, y, ky, False)
            again = self._engine_ids([middle])[0]
            if (kx == len(x) or again[0] == x[-kx]) and (ky == len(y) or again[-1] == y[ky - 1]):
                return a + b, x[: len(x) - kx] + again + y[ky:]
            k *= 2

    def encode_symbols(self, symbols: str) -> list[int]:
        """Tree concatenation of one unsplit string of symbols."""
        if len(symbols) <= self.leaf:
            return self._engine_ids([symbols])[0]
        spans = [(0, len(symbols))]
        while any(b - a > self.leaf for a, b in spans):
            spans = [s for a, b in spans for s in (((a, (a + b) // 2), ((a + b) // 2, b)) if b - a > self.leaf else ((a, b),))]
        leaves = [symbols[a:b] for a, b in spans]
        level = list(zip(leaves, self._engine_ids(leaves)))
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0][1]

    def pieces(self, run: str) -> list[str]:
        """Pre-tokens of a run without special tokens, as strings of symbols."""
        if run.isprintable():
            # Every Latin-1 character is its own NFC form, and the classes of letters and numbers are settled there.
            try:
                run.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                low = run.lower()
                found = (low,) if low.isalpha() else self.latin.findall(low)
                return found if run.isascii() else [x.encode().decode("latin-1").translate(self.byte_symbols) for x in found]
        text = self.normalizer.normalize_str(run) if self.normalizer else run
        return [x for x, _ in self.pre_tokenizer.pre_tokenize_str(text) if x]

    def _piece(self, piece: str) -> bytes:
        symbols = piece[:-1] + self.ending.get(piece[-1], piece[-1] + self.suffix) if self.suffix and self.tree else piece
        if len(symbols) > self.leaf and self.tree:
            return np.array(self.encode_symbols(symbols), dtype=np.int32).tobytes()
        as_bytes = self.id_bytes
        ids = self.parts[piece] = b"".join([as_bytes[t.id] for t in self.tokenize(symbols)])
        return ids

    def word(self, run: str) -> bytes:
        """Ids of one run, as 32-bit integers in bytes."""
        get = self.parts.get
        if run.isascii():
            piece = run.lower()
            if piece.isalpha():
                return get(piece) or self._piece(piece)
            core, mark = piece[:-1], piece[-1:]
            if core.isalpha() and mark in ".,;:!?":  # a word and its punctuation
                return (get(core) or self._piece(core)) + (get(mark) or self._piece(mark))
        out = []
        for p in self.cut_special.split(run) if self.cut_special and self.cut_special.search(run) else (run,):
            if p in self.special:
                out.append(self.id_bytes[self.special[p]])
            else:
                out += [get(x) or self._piece(x) for x in self.pieces(p)]
        return b"".join(out)

    def words(self, runs: list[str]) -> list[bytes]:
        if len(self.parts) > self.cache:
            self.parts.clear()
        word = self.word
        return [word(w) for w in runs]

    # ---- texts --------------------------------------------------------------------
    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch(pa.array([text], pa.string()))[0].as_py()

    def encode_batch(self, texts) -> pa.ListArray:
        if not self.tree or not (pc.max(pc.utf8_length(texts)).as_py() or 0) > self.text_leaf:
            return self._encode_leaves(texts)
        return self.encode_texts(texts.to_pylist())

    def _encode_leaves(self, texts) -> pa.ListArray:
        return encode_by_runs(texts, self.known, self.words, self.cache)

    def encode_texts(self, texts: list[str | None]) -> pa.ListArray:
        """Tree concatenation of whole texts."""
        tree = [Node(t or "", 0, len(t or "")) for t in texts]
        levels, leaves = [tree], []
        while levels[-1]:
            below = []
            for node in levels[-1]:
                below += node.halve(self.text_leaf)
                if not node.halves:
                    leaves.append(node)
            levels.append(below)
        for node, ids in zip(leaves, _arrays(self._encode_leaves(pa.array([n.text[n.start : n.stop] for n in leaves], pa.string())))):
            node.ids = ids
        for level in reversed(levels):
            self._join_level([n for n in level if n.halves])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(n.ids) for n in tree])]).astype(np.int32)), pa.array(np.concatenate([*(n.ids for n in tree), np.zeros(0, np.int32)])))

    def _join_level(self, nodes: list["Node"]) -> None:
        """Join the halves of the nodes, whose ids are known, all windows of one size at once."""
        runs = 1
        while nodes:
            windows, parts = [n.window(runs) for n in nodes], []
            for n, (a, b) in zip(nodes, windows):
                parts += [n.text[a : n.cut], n.text[a:b], n.text[n.cut : b]]
            found, again = _arrays(self._encode_leaves(pa.array(parts, pa.string()))), []
            for i, (n, (a, b)) in enumerate(zip(nodes, windows)):
                tail, middle, head = found[3 * i : 3 * i + 3]
                left, right = n.halves
                if (a == n.start or not len(tail) or len(middle) and middle[0] == tail[0]) and (b == n.stop or not len(head) or len(middle) and middle[-1] == head[-1]):
                    n.ids = np.concatenate([left.ids[: len(left.ids) - len(tail)], middle, right.ids[len(head) :]])
                    n.halves = ()
                    self.joins += 1
                else:
                    again.append(n)
                    self.grown += 1
            nodes, runs = again, 2 * runs

    def decode(self, ids) -> str:
        """As the library does without a decoder: the tokens' strings joined by one space; unknown ids give nothing."""
        return self.decode_batch(pa.array([list(ids)], pa.list_(pa.int32())))[0].as_py()

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        base, end = ids.offsets[0].as_py(), ids.offsets[-1].as_py()
        flat, ends = ids.values.slice(base, end - base), np.asarray(ids.offsets) - base
        strange = pc.invert(pc.fill_null(pc.is_in(flat, self.all_ids), False))
        if pc.any(strange).as_py():
            keep = ~np.asarray(strange)
            flat, ends = flat.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(keep)])[ends]
        names = self.names.take(flat)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names), " ")


class Node:
    """A part of a text in the tree: its bounds, halves and ids."""

    __slots__ = ("text", "start", "stop", "cut", "halves", "ids")

    def __init__(self, text: str, start: int, stop: int):
        self.text, self.start, self.stop, self.cut, self.halves, self.ids = text, start, stop, start, (), None

    def halve(self, leaf: int) -> tuple["Node", ...]:
        """Its halves, if it is longer than a leaf and both have white space."""
        if self.stop - self.start > leaf:
            cut = (self.start + self.stop) // 2
            if self._before(self.start, cut) >= 0 and self._after(cut, self.stop) >= 0:
                self.cut, self.halves = cut, (Node(self.text, self.start, cut), Node(self.text, cut, self.stop))
        return self.halves

    def _before(self, start: int, stop: int) -> int:
        """The last space or line end within the bounds, -1 if there is none."""
        at = self.text.rfind(" ", start, stop)
        return max(at, self.text.rfind("\n", max(at, start), stop))

    def _after(self, start: int, stop: int) -> int:
        at = self.text.find(" ", start, stop)
        line = self.text.find("\n", start, stop if at < 0 else at)
        return at if line < 0 else line

    def window(self, runs: int) -> tuple[int, int]:
        """From the start of a run to the end of one, so many whole runs on either side of the runs at the cut; ends at the node's own ends."""
        a = b = self.cut
        for _ in range(runs + 1):
            a = self._before(self.start, a)
            if a < 0:
                break
        for _ in range(runs + 1):
            at = self._after(b, self.stop)
            if at < 0:
                return (a + 1 if a >= 0 else self.start), self.stop
            b = at + 1
        return (a + 1 if a >= 0 else self.start), b - 1


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists as views of their values."""
    ends, flat = np.asarray(lists.offsets).tolist(), np.asarray(lists.values)
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def encode_by_runs(texts: pa.Array, known: dict[str, bytes], encode_runs, most: int = CACHE_WORDS) -> pa.ListArray:
    """Ids of each text from those of its runs between spaces and line ends; encode_runs is asked once for those that aren't known.

    Splitting, finding the distinct runs and laying out the ids are done by Arrow. `known`
    keeps `most` runs; when it would have more, only those of the last batch stay.
    """
    split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
    coded = split.values.dictionary_encode()
    runs = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist()
    ids = list(map(known.get, runs))
    new = [i for i, x in enumerate(ids) if x is None]
    if len(known) + len(new) > most:
        known.clear()
        known.update((w, x) for w, x in zip(runs, ids) if x is not None)
    for i, x in zip(new, encode_runs([runs[i] for i in new])):
        ids[i] = x
        if len(runs[i]) <= LONG_WORD:
            known[runs[i]] = x
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    starts = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    each = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))
    laid = each.take(coded.indices)
    at = np.asarray(laid.offsets)[np.asarray(split.offsets)]
    return pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), laid.values.slice(at[0], at[-1] - at[0]))


_coders: dict[tuple[str, bool], TreeBpe] = {}


def coder(path: str, tree: bool = True) -> TreeBpe:
    if (path, tree) not in _coders:
        _coders[path, tree] = TreeBpe(path, tree=tree, cache=CACHE_WORDS if tree else PLAIN_CACHE_WORDS)
    return _coders[path, tree]


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def slices(batch: pa.RecordBatch, column: str, most: int = 4_000_000):
    """Parts of a batch of about so many bytes of text each, a row at least."""
    col = batch.column(batch.schema.get_field_index(column))
    if not len(col):
        return
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
    at = 0
    while at < len(col):
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """df with the token ids of each whole text as array<int> in ids_col and, if a name is given, what they decode to in decoded_col.

    A name that df already has gets underscores in front.
    """
    ids_col = free_name(df, ids_col)
    fields = [*df.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_col:
        decoded_col = free_name(df, decoded_col)
        fields.append(T.StructField(decoded_col, T.StringType(), False))
    schema = T.StructType(fields)
    bounded_batches(df.sparkSession)

    def run(batches):
        c = coder(path)
        for whole in batches:
            for batch in slices(whole, text_col):
                ids = c.encode_batch(batch.column(batch.schema.get_field_index(text_col)))
                out = _with_column(batch, ids_col, ids)
                yield _with_column(out, decoded_col, c.decode_batch(ids)) if decoded_col else out

    return df.mapInArrow(tidied(run), schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """df with the decoded text of each array of ids; null ids decode to the empty string."""
    decoded_col = free_name(df, decoded_col)
    schema = T.StructType([*df.schema.fields, T.StructField(decoded_col, T.StringType(), False)])

    bounded_batches(df.sparkSession)

    def run(batches):
        c = coder(path)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids_col))
            ends = np.asarray(col.offsets)
            at = 0
            while at < len(col):  # in bounded parts: decoded texts can be far larger than their ids
                n = max(1, int(np.searchsorted(ends, ends[at] + 1_000_000, "right")) - 1 - at)
                part = batch.slice(at, n)
                yield _with_column(part, decoded_col, c.decode_batch(pc.fill_null(col.slice(at, n), [])))
                at += n

    return df.mapInArrow(tidied(run), schema)


def digests(df: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> list:
    return [
        F.size(ids_col).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col), 256).alias("decoded_sha256"),
    ]
