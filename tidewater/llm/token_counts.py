"""Exact token counts of every prefix of a text, by dynamic programming over code points, stored and asked.

The byte-level vocabulary never merges across the words that its pre-tokenizer cuts, so a prefix that ends in a word has the tokens
up to the word and those of the word's own prefix. Within a word, ``tokens(prefix) = tokens(prefix without its last token) + 1``, where the last token is
the one token at its end that the merges leave beside the last token of what stands before. A text is cut into units, white space and the
run after it; a prefix that ends in white space belongs to the same unit, so the counts of equal units are equal wherever they stand.

``prefix_table`` stores each text's counts as the steps from one prefix to the next, two bytes a code point, which compress well; all else is asked of that
table: the whole count, whether a budget is passed, and where a text is to be cut, for any number of budgets, without the vocabulary.
Units of one word and signs, nearly all, are counted side by side for many texts: their tokens come from the vocabulary's tree, a byte deeper at a time, and all
prefixes of one length get their last token together. What is held of units, beginnings of words and pairs of tokens is bounded by numbers of short entries, some 250 MB a worker.

Null text counts as empty: no tokens and no prefixes. Empty tables give empty results. Rows are counted one by one,
so repeated ids or rows each give a row. Other input columns are left alone and not read. Texts of megabytes are counted in the same way; long runs are not held.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate, pairwise
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import slices, written

#: Unicode white space as the vocabulary's own pre-tokenizer takes it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: White space and the run without it that follows. The pre-tokenizer cuts these further, but never joins two of them.
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
LEAD = re.compile(f"[{SPACE}]*")
#: A step is at most as large as the longest token, so far under this.
STEP = np.int16
#: Entries of each generation of units and pairs, nodes of the tree of words; code points of the longest unit that is held, and of the beginnings that words share.
UNITS, NODES, PAIRS, LONGEST, BEGINNING = 250_000, 200_000, 200_000, 40, 8
#: At most a line's end or a tab, letters behind at most one space, and then signs that are no letters, digits or apostrophes: the byte-level pre-tokenizer's own expression cuts these apart.
PLAIN = re.compile(r"([\t\n\r](?! ))?( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
#: The bytes for which characters stand: those that print as none are written as characters from U+0100 on, in order.
BYTE_OF = {chr(256 + k): b for k, b in enumerate([*range(33), *range(127, 161), 173])}
BYTE_OF |= {chr(b): b for b in range(256) if b not in set(BYTE_OF.values())}
#: Units that are counted together, and code points of texts that share a count of units.
PIECE, ROOM = 50_000, 1_000_000


class Memo:
    """A bounded map in two generations: what was asked since the last change of generation stays, the rest goes."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def held(self, keys: set) -> dict:
        """What is held of the keys."""
        young, old = self.young, self.old
        found = {k: young[k] for k in keys if k in young}
        for k in [k for k in keys.difference(found) if k in old] if old else []:
            found[k] = old[k]
            self.put(k, old[k])
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def spread(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places for numbers in a table of 2 ** bits."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class Edges:
    """A map of distinct whole numbers from 0 on to others from 1 on, asked for many at once; 0 is for what it does not hold."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(3, (4 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        at = spread(keys, self.bits)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            here = self.keys[at] == keys
            self.values[at[here]] = values[here]
            keys, values, at = keys[~here], values[~here], (at[~here] + 1) % len(self.keys)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = spread(keys, self.bits)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], 0)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) % len(self.keys)
            held = self.keys[at[left]]
            here = held == keys[left]
            out[left[here]] = self.values[at[left[here]]]
            left = left[~here & (held >= 0)]
        return out


def tree_of(tokens: list[bytes]) -> tuple[Edges, np.ndarray]:
    """The tree of all beginnings of tokens: from 256 times a node plus a byte to the next node, and the number of the token that each node is, or -1. The root is 0."""
    sizes = np.array(list(map(len, tokens)), np.int64)
    data, starts = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes
    state, at, nodes, keys = np.zeros(len(tokens), np.int64), np.arange(len(tokens)), 1, [np.empty(0, np.int64)]
    for k in range(sizes.max(initial=0)):
        at = at[sizes[at] > k]
        own, place = np.unique(state[at] << 8 | data[starts[at] + k], return_inverse=True)
        state[at] = nodes + place
        nodes += len(own)
        keys.append(own)
    token_at = np.full(nodes, -1, np.int64)
    token_at[state] = np.arange(len(tokens))
    return Edges(np.concatenate(keys), np.arange(1, nodes)), token_at


class PrefixCounter:
    """Counts tokens of all prefixes with a byte-level vocabulary of the tokenizers library."""

    def __init__(self, vocabulary: str, units: int = UNITS, nodes: int = NODES, pairs: int = PAIRS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens = set(self.tokenizer.get_vocab(with_added_tokens=False))
        endings: dict[str, set[int]] = defaultdict(set)
        for t in self.tokens:
            endings[t[-3:]].add(len(t))
        #: by the last three bytes, the lengths that tokens with this end have, longest first
        self.lengths = {e: sorted(n | {1, 2}, reverse=True) for e, n in endings.items()}
        self.units, self.stands = Memo(units), Memo(pairs)
        self.tree, self.nodes, self.most = ("", 0, {}), 0, nodes
        kind = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        #: the tokens by number, at the end the empty one; the tree of their bytes, and the token that each of its nodes is
        self.names = [*sorted(t for t in self.tokens if all(c in BYTE_OF for c in t)), ""]
        written_out = [bytes(map(BYTE_OF.__getitem__, t)) for t in self.names[:-1]]
        self.edges, self.token_at = tree_of(written_out)
        #: pairs of numbers that were asked last, twice the pair and 1 if it stands
        self.bits = max(3, (8 * pairs).bit_length())
        self.held = np.full(1 << self.bits, -1, np.int64)
        whole = sum(len(t) == 1 for t in written_out) == 256
        self.plain = PLAIN.fullmatch if whole and kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space") else None

    def beside(self, last: str, token: str) -> bool:
        """Whether the merges keep ``last`` and ``token`` apart and whole; ``last`` is empty at a word's start."""
        pair = (last, token)
        if (found := self.stands.get(pair)) is None:
            found = [t.value for t in self.tokenizer.model.tokenize(last + token)] == [t for t in pair if t]
            self.stands.put(pair, found)
        return found

    def word(self, mapped: str) -> list[int]:
        """Number of tokens of each prefix of one word of the pre-tokenizer, from the empty one on; the word is written with a character for each byte.

        Words that begin alike share what is known of their beginning, in a tree by characters; a node has the last token and the number of tokens.
        """
        last, counts = [""], [0]
        node = self.tree
        for char in mapped:
            child = node[2].get(char)
            if child is None:
                break
            last.append(child[0])
            counts.append(child[1])
            node = child
        if len(counts) > len(mapped):
            return counts
        tokens, lengths, stands = self.tokens, self.lengths, self.stands.young
        for end in range(len(counts), len(mapped) + 1):
            for n in lengths.get(mapped[end - 3 : end], (2, 1)) if end > 2 else range(end, 0, -1):
                if n <= end and (token := mapped[end - n : end]) in tokens:
                    before = last[end - n]
                    fits = stands.get((before, token))
                    if self.beside(before, token) if fits is None else fits:
                        count = counts[end - n] + 1
                        last.append(token)
                        counts.append(count)
                        if end <= BEGINNING:
                            node[2][mapped[end - 1]] = node = (token, count, {})
                            self.nodes += 1
                        break
        if self.nodes > self.most:
            self.tree, self.nodes = ("", 0, {}), 0
        return counts

    def byte_steps(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The steps at each byte of words that stand side by side, all words at once; ``begins`` has the place where each begins.

        All tokens at all places come from the vocabulary's tree, one byte deeper at a time. Then ends of prefixes get their last token, the shortest prefixes first
        and of one length the longest tokens first, as what stands before a token must be known.
        """
        sizes = np.diff(begins, append=len(data))
        begin, end_of = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
        at, state, size, found = np.arange(len(data)), np.zeros(len(data), np.int64), 0, []
        while len(at):
            state = self.edges.get(state << 8 | data[at + size])
            at, state, size = at[state > 0], state[state > 0], size + 1
            token = self.token_at[state]
            own = np.flatnonzero(token >= 0)
            found.append((at[own], token[own], np.full(len(own), size)))
            more = at + size < end_of[at]
            at, state = at[more], state[more]
        start, token, size = map(np.concatenate, zip(*found))
        rank = (start + size - begin[start]) * 256 - size
        order = np.argsort(rank.astype(np.int16) if rank.max(initial=0) < 32768 else rank, kind="stable")
        start, token, end, rank = start[order], token[order], (start + size)[order] - 1, rank[order]
        alone = start == begin[start]
        last, counts = np.full(len(data), -1), np.zeros(len(data), np.int64)
        edges = [0, *(np.flatnonzero(np.diff(rank)) + 1).tolist(), len(rank)]
        for i, j in pairwise(edges):
            k = i + np.flatnonzero(last[end[i:j]] < 0)
            before = np.where(alone[k], len(self.names) - 1, last[start[k] - 1])
            fits = self.side_by_side(before, token[k])
            k = k[fits]
            last[end[k]] = token[k]
            counts[end[k]] = 1 + np.where(alone[k], 0, counts[start[k] - 1])
        steps = np.diff(counts, prepend=0)
        steps[begins] = counts[begins]
        return steps

    def side_by_side(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``beside`` for many pairs of numbers of tokens; a pair that is not where it would be held is asked of the library and takes the place."""
        pairs = before * len(self.names) + token
        places = spread(pairs, self.bits)
        held = self.held[places]
        fits, new = (held & 1).astype(bool), np.flatnonzero(held >> 1 != pairs)
        if len(new):
            asked, place = np.unique(pairs[new], return_inverse=True)
            names, model = self.names, self.tokenizer.model
            told = []
            for a, b in zip(*(x.tolist() for x in divmod(asked, len(names)))):
                apart = model.tokenize(names[a] + names[b])
                told.append(len(apart) == 1 + (a < len(names) - 1) and apart[-1].value == names[b])
            told = np.array(told)
            self.held[spread(asked, self.bits)] = asked << 1 | told
            fits[new] = told[place]
        return fits

    def plain_steps(self, units: list[str], cuts: list[tuple[int, int]]) -> list[bytes]:
        """The steps of plain units, from where their letters and their signs begin; each word begins anew, so all words stand side by side."""
        data = np.frombuffer("".join(units).encode(), np.uint8)
        sizes = np.array(list(map(len, units)))
        ends = np.cumsum(sizes)
        begins = np.column_stack([ends - sizes, (ends - sizes)[:, None] + np.array(cuts)])
        begins = np.unique(begins[begins < ends[:, None]])
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        steps = np.add.reduceat(self.byte_steps(data, chars[begins]), chars).astype(STEP).tobytes()
        edges = [0, *(ends * np.dtype(STEP).itemsize).tolist()]
        return [steps[i:j] for i, j in pairwise(edges)]

    def unit_counts(self, text: str) -> list[int]:
        """Tokens up to each code point of a unit."""
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        out, before = [], 0
        for mapped, (start, end) in words:
            counts = self.word(mapped)
            if len(mapped) == end - start:
                out += [before + n for n in counts[1:]] if before else counts[1:]
            else:
                out += [before + counts[b] for b in accumulate(len(c.encode()) for c in text[start:end])]
            before += counts[-1]
        # the last white space before a run is a word of its own or the run's, but ends the prefix as part of all white space before
        space = LEAD.match(text).end() if len(words) > 1 else 0
        if 1 < space < len(text):
            out[space - 1] = self.unit_counts(text[:space])[-1]
        return out

    def units_steps(self, units: set[str]) -> dict[str, bytes]:
        """The steps of each unit's counts; plain ones that are not held are counted together."""
        found, plain, cuts = self.units.held(units), [], []
        for unit in units.difference(found):
            if self.plain and len(unit) <= LONGEST and (cut := self.plain(unit)):
                plain.append(unit)
                cuts.append((cut.start(2), cut.end(2)))
            else:
                counts = self.unit_counts(unit)
                found[unit] = array("h", map(sub, counts, [0, *counts])).tobytes()
                if len(unit) <= LONGEST:
                    self.units.put(unit, found[unit])
        for k in range(0, len(plain), PIECE):
            for unit, steps in zip(plain[k : k + PIECE], self.plain_steps(plain[k : k + PIECE], cuts[k : k + PIECE]), strict=True):
                found[unit] = steps
                self.units.put(unit, steps)
        return found

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at the odd places."""
        return re.split("(" + "|".join(map(re.escape, self.specials)) + ")", text) if any(s in text for s in self.specials) else [text]

    def steps(self, text: str) -> bytes:
        """How many tokens more each prefix of the text has than the one before. A special string is one token where it is whole, as the library takes it by default, else plain text."""
        parts = self.parts(text)
        if len(parts) == 1:
            units = UNIT.findall(text)
            pieces = [units[k : k + PIECE] for k in range(0, len(units), PIECE)]
            return b"".join(b"".join(map(self.units_steps(set(p)).__getitem__, p)) for p in pieces)
        out, before, last, start = [], 0, "", 0
        for k, part in enumerate(parts):
            if k % 2:  # all but its end is plain text that lengthens the unit before it
                own = [start + n for n in self.unit_counts(last + part[:-1])[len(last) :]]
                out += [*own, before + 1]
                before, last, start = before + 1, "", before + 1
            else:
                for unit in UNIT.findall(part):
                    own = self.unit_counts(unit)
                    out += [before + n for n in own]
                    last, start, before = unit, before, before + own[-1]
        return np.diff(np.array(out, np.int64), prepend=0).astype(STEP).tobytes()

    def all_steps(self, texts: list[str]) -> list[bytes]:
        """The steps of several texts; what texts of ``ROOM`` code points together have in common is counted once."""
        out, at = [], 0
        while at < len(texts):
            end, room = at + 1, ROOM - len(texts[at])
            while end < len(texts) and (room := room - len(texts[end])) >= 0:
                end += 1
            cut = [UNIT.findall(t) if len(t) <= ROOM and not any(s in t for s in self.specials) else None for t in texts[at:end]]
            found = self.units_steps(set().union(*(c for c in cut if c)))
            out += [self.steps(t) if c is None else b"".join(map(found.__getitem__, c)) for t, c in zip(texts[at:end], cut, strict=True)]
            at = end
        return out

    def counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:k]`` for each k from 1 on."""
        return counts_of(self.steps(text))


def counts_of(steps: bytes) -> np.ndarray:
    """The counts of all prefixes from their steps."""
    return np.cumsum(np.frombuffer(steps, STEP), dtype=np.int32)


def fitting(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens; a longer prefix may have fewer tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_table(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes`` of the text in UTF-8, and ``steps``, whose k-th entry is what the prefix of k code points has more than that of k - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(vocabulary)
        for batch in slices(batches, 256):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = counter.all_steps(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(found, pa.binary())], ["__id", "n_bytes", "steps"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, f"__id {kind}, n_bytes long, steps binary")
    return out.withColumnRenamed("__id", id_col)


def asked(stored: DataFrame, budgets: list[int], id_col: str = "doc_id") -> DataFrame:
    """Per row of a prefix table: the id, ``n_bytes``, ``n_tokens`` and ``fit_chars array<long>``, for each budget the code points of the longest prefix within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            n_tokens, fit = [], []
            for steps in batch.column("steps").to_pylist():
                counts = counts_of(steps)
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                fit.append([fitting(counts, b) for b in budgets])
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("n_bytes"), pa.array(n_tokens, pa.int64()), pa.array(fit, pa.list_(pa.int64()))], ["__id", "n_bytes", "n_tokens", "fit_chars"])

    kind = stored.schema[id_col].dataType.simpleString()
    rows = stored.select(F.col(id_col).alias("__id"), "n_bytes", "steps")
    return rows.mapInArrow(run, f"__id {kind}, n_bytes long, n_tokens long, fit_chars array<long>").withColumnRenamed("__id", id_col)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars``, the code points of the longest prefix within the limit; the prefix table is written once and asked."""
    found = asked(written(prefix_table(docs, vocabulary, id_col, text_col), "prefix-counts"), [limit], id_col)
    return found.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), F.col("fit_chars")[0].alias("fit_chars"))
