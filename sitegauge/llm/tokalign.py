"""Alignment of two tokenizers' tokens over the same text.

Each text is encoded by a byte-level BPE (A, of the tokenizers library, after a
space) and by a SentencePiece model (B, which adds the space). Where tokens end:

* the libraries' spans are coarse cuts: A's character offsets become byte
  offsets, B's spans (those of its result message) are bytes already;
* a token whose span has as many bytes as the token decodes to is cut there;
  tokens of parts of a character, whose spans are the whole character or
  nothing, are cut by the decoded bytes since the last such cut.

Byte offsets where an A and a B token both end cut the tokens into groups. All
A-B pairs of a group are linked; a pair of ids counts the documents that hold it
linked, in the whole corpus.

Shape of the work: a task encodes texts in blocks of about ``BLOCK_BYTES`` and
writes, with every document, its pairs as numbers into the block's list of
distinct pairs, which stands once for the block. Only the blocks' lists are
shuffled by pair (counts, and the best count of an A id), so a common pair costs
one row a block, not one a document; the counts then return to their block and
meet its documents. Both tokenizers work word by word where that changes no
token (neither's pieces run on across a space; else on whole texts). A word's
tokens end together at its end, so its groups are its own: a worker keeps the
groups and linked pairs of recent words (about ``WORDS``; when there are more, those
met in several calls stay) and puts texts together from them. For the same reason new
words are encoded many at once, as one text, whose tokens are told apart by their
bytes.

Defined results: a text that is null, empty, or that a tokenizer doesn't give
back byte for byte (the space marker itself in a text, for one) has no tokens:
zeros and an empty digest. Special tokens' strings in a text are plain text.
Repeated rows are documents of their own; ids play no part, so they may be null
or repeat. Extra columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import partial
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.sentencepiece import BYTE, MARK, NORMAL, USER_DEFINED, parse_model
from sitegauge.llm.tables import freeze, read

#: Where the public vocabulary files are, unless a caller names others.
VOCABULARY, MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text that are encoded at once, and that share one list of pairs.
CALL_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20
#: Pairs that are written out one by one at once.
EXPAND = 1 << 22
#: Words (and, 16 times as many, pairs) that a worker keeps before it leaves half of them.
WORDS = 400_000
#: Bytes of new words that are encoded as one text.
RUN_BYTES = 1 << 12
#: White space in UTF-8, as numbers of one, two and three bytes.
BLANKS = [np.array([int.from_bytes(x) for x in (chr(i).encode() for i in range(1 << 16) if chr(i).isspace()) if len(x) == n])
          for n in (1, 2, 3)]


def byte_letters() -> dict[str, int]:
    """The byte behind each sign of a byte-level vocabulary: printable signs of
    Latin-1 stand for themselves, the other bytes for signs from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SideA:
    """The byte-level BPE: ids and spans in bytes of each word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            data = f.read()
        self.tok = Tokenizer.from_str(data)
        self.tok.encode_special_tokens = True
        letters = byte_letters()
        self.bytes = [b""] * self.tok.get_vocab_size(with_added_tokens=True)
        read = json.loads(data)
        special = {x["id"] for x in read.get("added_tokens", ())}
        for text, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = text.encode() if i in special else bytes(letters[c] for c in text)
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)
        # Words are cut from what follows where a space follows no space: the
        # vocabulary's own cutting does the same if it is the byte-level one.
        self.by_word = (read.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not read.get("normalizer")

    def encode(self, words: list[str]):
        """(ids, spans in characters) of each word."""
        return ((got.ids, got.offsets) for got in self.tok.encode_batch(words, add_special_tokens=False))

    def in_bytes(self, spans: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: list[str], raw: list[bytes]) -> np.ndarray:
        """Spans in bytes; ``starts`` and ``sizes`` are each word's tokens."""
        text = np.frombuffer(b"".join(raw), np.uint8)
        at = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))    # of every character
        first = np.cumsum([0, *map(len, words)])[:-1]
        return at[spans + np.repeat(first, sizes)[:, None]] - np.repeat(at[first], sizes)[:, None]


class SideB:
    """The SentencePiece model: the same of its pieces, for words without the space it adds."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        model = parse_model(data)
        self.bytes = [bytes([int(t[1:-1], 16)]) if k == BYTE else t.replace(MARK, " ").encode() for t, _, k in model.pieces]
        self.sizes = np.array([len(b) for b in self.bytes], dtype=np.int64)
        usable = [t for t, _, k in model.pieces if MARK in t and k in (NORMAL, USER_DEFINED)]
        #: no piece runs on across a space, and spaces are kept as they are
        self.by_word = (model.add_dummy_prefix and not model.remove_extra_spaces and not model.charsmap
                        and all(MARK not in t.lstrip(MARK) for t in usable))

    def encode(self, words: list[str]):
        """(ids, spans in bytes behind the added space) of each word."""
        # the spans are those of the library's result message, given as lists
        return ((got["ids"], got["offsets"]) for got in self.sp.encode(
            [w[1:] for w in words], return_type="offset_mapping", return_bytes=True, num_threads=1))

    def in_bytes(self, spans: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words: list[str], raw: list[bytes]) -> np.ndarray:
        """Spans of the words with their space, which belongs to the first token."""
        spans = spans + 1
        spans[starts[sizes > 0], 0] = 0
        return spans


def cuts(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where tokens end: at their span's end if the span is of the decoded size,
    else as many decoded bytes behind the last such end. ``starts`` is the index
    of the first token of each token's word; all offsets count from the word."""
    count = np.cumsum(sizes)
    count = count - (count - sizes)[starts]
    at = np.arange(len(sizes))
    last = np.maximum.accumulate(np.where(ends - begins == sizes, at, -1))
    refined = np.where(last < starts, count, ends[last] + count - count[last])
    # a span that contradicts the bytes before it gives way to them
    return np.where(refined == count, refined, count)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs that begin at ``starts``, one after another."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + sizes, sizes)


def after_blank(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space stands before the bytes ``at`` of UTF-8 whose first
    character is of one byte."""
    blank = np.isin(np.arange(256), BLANKS[0])[text[at - 1]]
    wide = np.flatnonzero(text[at - 1] > 127)
    two = text[at[wide] - 2].astype(np.int64) << 8 | text[at[wide] - 1]
    three = text[np.maximum(at[wide] - 3, 0)].astype(np.int64) << 16 | two
    blank[wide] = np.isin(two, BLANKS[1]) | np.isin(three, BLANKS[2])
    return blank


def word_starts(text: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words begin in texts that begin at ``first``, each with a space: there,
    and at a space behind something that is no white space."""
    mark = text == 32
    at = np.flatnonzero(mark[1:]) + 1
    mark[at[after_blank(text, at)]] = False
    mark[np.append(first[1:], len(text)) - 1] = False     # B adds no space to an empty text
    mark[first] = True
    return np.flatnonzero(mark)


class Words:
    """Tokens of words for one side."""

    def __init__(self, side):
        self.side = side
        self.clear()

    def clear(self) -> None:
        self.ids = self.ends = self.starts = self.sizes = np.zeros(0, dtype=np.int64)
        self.same = np.zeros(0, dtype=bool)

    def runs(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The first words of the runs that are encoded as one text, which is cut into
        them again: none ends in white space. The space marker stands alone, as B
        doesn't give it back."""
        alone = after_blank(text, ends)
        mark = np.flatnonzero(text == MARK.encode()[-1])
        mark = mark[mark > 1]
        mark = mark[(text[mark - 1] == MARK.encode()[1]) & (text[mark - 2] == MARK.encode()[0])]
        alone[np.searchsorted(ends, mark, side="right")] = True
        part = np.append(0, ends[:-1]) // RUN_BYTES
        return np.flatnonzero(alone | np.append(True, alone[:-1] | (part[1:] != part[:-1])))

    def add(self, words: list[str], raw: list[bytes], joined: bool = False) -> None:
        """Encode further words; their numbers follow those of the words before. With
        ``joined`` (tokens don't run on from word to word) many are one text."""
        if not words:
            return
        side, text = self.side, b"".join(raw)
        count = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(count)
        first = self.runs(np.frombuffer(text, np.uint8), ends) if joined else np.arange(len(words))
        runs = list(zip(first.tolist(), [*first[1:].tolist(), len(words)]))
        told = list(side.encode(["".join(words[a:b]) for a, b in runs]))
        good = [b - a == 1 or b"".join([side.bytes[x] for x in i]) == b"".join(raw[a:b]) for (a, b), (i, _) in zip(runs, told)]
        if not all(good):
            # what isn't given back byte for byte is encoded again word by word
            single = [(i, i + 1) for (a, b), g in zip(runs, good) if not g for i in range(a, b)]
            again = dict(zip(single, side.encode([words[a] for a, _ in single])))
            told = [x for (a, b), g, x in zip(runs, good, told) for x in ([x] if g else [again[i, i + 1] for i in range(a, b)])]
            runs = [x for (a, b), g in zip(runs, good) for x in ([(a, b)] if g else [(i, i + 1) for i in range(a, b)])]
        first, last = np.array(runs, dtype=np.int64).reshape(-1, 2).T
        per_run = np.array([len(i) for i, _ in told], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(i for i, _ in told), np.int64, int(per_run.sum()))
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(s for _, s in told)), np.int64, 2 * len(ids)).reshape(-1, 2)
        # a token's word: that in which its bytes end; its run's only word, if it is one
        starts = np.cumsum(per_run) - per_run
        to = np.cumsum(side.sizes[ids])
        base = (ends - count)[first]
        to = to + np.repeat(base - np.append(0, to)[starts], per_run)
        many = np.repeat(last - first > 1, per_run)
        ended = np.zeros(len(text) + 1, dtype=np.int64)      # words before each byte
        ended[ends[:-1] + 1] = 1
        word = np.where(many, np.cumsum(ended)[np.minimum(to, len(text))], np.repeat(first, per_run))
        if (many & (to - side.sizes[ids] < (ends - count)[word])).any():
            return self.add(words, raw)      # a token of two words
        begins = side.in_bytes(spans, starts, per_run, ["".join(words[a:b]) for a, b in runs], [b"".join(raw[a:b]) for a, b in runs])
        begins = begins - ((ends - count)[word] - np.repeat(base, per_run))[:, None]
        sizes = np.bincount(word, minlength=len(words))
        starts = np.cumsum(sizes) - sizes
        ends = cuts(*begins.T, side.sizes[ids], np.repeat(starts, sizes))
        # bytes word by word only where a word was alone
        same = np.ones(len(words), dtype=bool)
        for a in first[last - first == 1].tolist():
            same[a] = b"".join([side.bytes[x] for x in ids[starts[a]:starts[a] + sizes[a]].tolist()]) == raw[a]
        self.starts = np.append(self.starts, starts + len(self.ids))
        self.sizes = np.append(self.sizes, sizes)
        self.ids, self.ends = np.append(self.ids, ids), np.append(self.ends, ends)
        self.same = np.append(self.same, same)

    def tokens(self, numbers: np.ndarray, at: np.ndarray):
        """(ids, ends, tokens of each word) of words that begin at the bytes ``at``."""
        sizes = self.sizes[numbers]
        where = _ragged(self.starts[numbers], sizes)
        return self.ids[where], self.ends[where] + np.repeat(at, sizes), sizes


def linked(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, doc_of: np.ndarray):
    """(document, a, b, links) of each document's distinct linked pairs, sorted. The
    groups' numbers of the tokens are sorted; ``doc_of`` is each group's document."""
    n = len(doc_of)
    size_a, size_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    keys, times = [], []

    def add(doc, x, y, w=None):
        key, inverse = np.unique(doc << 33 | x << 16 | y, return_inverse=True)
        keys.append(key)
        times.append(np.bincount(inverse, weights=w, minlength=len(key)).astype(np.int64))

    cost = size_a * size_b
    few = cost <= 4096
    # small groups in runs of EXPAND pairs
    order = np.flatnonzero(few)
    for part in np.split(order, np.searchsorted(np.cumsum(cost[order]), np.arange(EXPAND, cost[order].sum() + 1, EXPAND))):
        if len(part):
            of = np.repeat(part, cost[part])
            k = np.arange(len(of)) - np.repeat(np.cumsum(cost[part]) - cost[part], cost[part])
            add(doc_of[of], a[start_a[of] + k // size_b[of]], b[start_b[of] + k % size_b[of]])
    # large ones by their distinct ids
    for g in np.flatnonzero(~few).tolist():
        ids_a, n_a = np.unique(a[start_a[g]:start_a[g] + size_a[g]], return_counts=True)
        ids_b, n_b = np.unique(b[start_b[g]:start_b[g] + size_b[g]], return_counts=True)
        step = max(1, EXPAND // len(ids_b))
        for s in range(0, len(ids_a), step):
            x = ids_a[s:s + step]
            add(np.full(len(x) * len(ids_b), doc_of[g]), np.repeat(x, len(ids_b)), np.tile(ids_b, len(x)),
                np.outer(n_a[s:s + step], n_b).ravel())
    if not keys:
        return (np.zeros(0, np.int64),) * 2
    if len(keys) == 1:
        return keys[0], times[0]
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, weights=np.concatenate(times)).astype(np.int64)


class Aligner:
    """Both tokenizers of a worker, and the words of its digests."""

    loaded: dict = {}

    def __init__(self, vocabulary: str, model: str):
        self.a, self.b = SideA(vocabulary), SideB(model)
        if len(self.b.bytes) > 1 << 16 or len(self.a.bytes) > 1 << 17:
            raise ValueError("ids are beyond the pairs' 33 bits")
        self.by_word = self.a.by_word and self.b.by_word
        self.words_a, self.words_b = Words(self.a), Words(self.b)
        digits = [str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))]
        self.wide = len(digits)
        self.signed = np.array([d + sign for sign in (",", "|", ";", "\n") for d in digits], dtype=object)
        #: of each kept word: its number, whether both sides give it back, in how many
        #: calls it was met, its A tokens, B tokens and groups, its groups' text, and
        #: its linked pairs with their links
        self.known: dict[bytes, int] = {}
        self.same, self.met = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int32)
        self.sums = np.zeros((3, 0), dtype=np.int32)
        self.texts = np.zeros(0, dtype=object)
        self.starts = self.sizes = self.pairs = np.zeros(0, dtype=np.int64)
        self.times = np.zeros(0, dtype=np.int32)

    def starts_in(self, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where words begin in texts that begin at ``first``."""
        return word_starts(text, first) if self.by_word else first

    def cut(self, text: str) -> list[str]:
        """The words of " " + text."""
        raw = (" " + text).encode()
        starts = self.starts_in(np.frombuffer(raw, np.uint8), np.zeros(1, dtype=np.int64)).tolist()
        return [raw[x:y].decode() for x, y in zip(starts, [*starts[1:], len(raw)])]

    def keep(self) -> None:
        """Leave words until there is room for as many again; those met in most calls stay."""
        stay = np.argsort(-self.met, kind="stable")[:WORDS // 2]
        stay = stay[(self.met[stay] > 1) & (np.cumsum(self.sizes[stay]) <= 8 * WORDS)]
        words = list(self.known)
        self.known = {words[i]: k for k, i in enumerate(stay.tolist())}
        self.same, self.sums, self.texts = self.same[stay], self.sums[:, stay], self.texts[stay]
        where, self.sizes = _ragged(self.starts[stay], self.sizes[stay]), self.sizes[stay]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pairs, self.times, self.met = self.pairs[where], self.times[where], np.zeros(len(stay), dtype=np.int32)

    def number(self, words: list[bytes]) -> np.ndarray:
        """Each distinct word's number; new words are encoded."""
        if len(self.known) > WORDS or len(self.pairs) > 16 * WORDS:
            self.keep()
        known, before = self.known, len(self.known)
        numbers = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
        if len(known) > before:
            self.learn(list(islice(known, before, None)))
        self.met[numbers] += 1
        return numbers

    def learn(self, raw: list[bytes]) -> None:
        """Groups and linked pairs of further words."""
        new, n = [w.decode() for w in raw], len(raw)
        for side in (self.words_a, self.words_b):
            side.clear()
            side.add(new, raw, self.by_word)
        same = self.words_a.same & self.words_b.same
        good = np.flatnonzero(same)
        sizes = np.fromiter(map(len, raw), np.int64, n)[good]
        starts = np.cumsum(sizes) - sizes
        a, ends_a, per_a = self.words_a.tokens(good, starts)
        b, ends_b, per_b = self.words_b.tokens(good, starts)
        marks = np.zeros((2, int(sizes.sum()) + 1), dtype=bool)
        marks[0, ends_a] = marks[1, ends_b] = True
        both = marks[0] & marks[1]
        # a token's group: common ends before its own
        before = np.cumsum(both) - both
        group_a, group_b = before[ends_a], before[ends_b]
        word_of = np.zeros(int(both.sum()), dtype=np.int64)
        word_of[group_a] = np.repeat(good, per_a)
        key, times = linked(a, b, group_a, group_b, word_of)
        # tokens in the order of the digest: each group's A tokens, then its B tokens
        last_a, last_b = (np.cumsum(np.bincount(g, minlength=len(word_of))) for g in (group_a, group_b))
        place_a = np.arange(len(a)) + np.append(0, last_b)[group_a]
        place_b = np.arange(len(b)) + last_a[group_b]
        sign_a = np.where(np.append(group_a[1:] != group_a[:-1], True), 1, 0)
        last = np.append(group_b[1:] != group_b[:-1], True)
        ends_word = np.append(word_of[1:] != word_of[:-1], True)[group_b]
        sign_b = np.where(last, np.where(ends_word, 3, 2), 0)
        tokens = np.empty(len(a) + len(b), dtype=object)
        tokens[place_a] = self.signed[sign_a * self.wide + a]
        tokens[place_b] = self.signed[sign_b * self.wide + b]
        texts, sums = np.full(n, b"", dtype=object), np.zeros((3, n), dtype=np.int32)
        texts[good] = "".join(tokens.tolist()).encode().split(b"\n")[:-1]
        sums[0, good], sums[1, good] = per_a, per_b
        sums[2] = np.bincount(word_of, minlength=n)
        of = np.bincount(key >> 33, minlength=n)
        self.starts = np.append(self.starts, np.cumsum(of) - of + len(self.pairs))
        self.sizes = np.append(self.sizes, of)
        self.pairs = np.append(self.pairs, key & (1 << 33) - 1)
        self.times = np.append(self.times, times.astype(np.int32))
        self.same, self.texts = np.append(self.same, same), np.append(self.texts, texts)
        self.sums = np.append(self.sums, sums, axis=1)
        self.met = np.append(self.met, np.zeros(n, dtype=np.int32))

    @classmethod
    def of(cls, vocabulary: str, model: str) -> Aligner:
        if (vocabulary, model) not in cls.loaded:
            cls.loaded[vocabulary, model] = cls(vocabulary, model)
        return cls.loaded[vocabulary, model]

    def align(self, texts: list):
        """(n_a, n_b, n_groups, n_links, digest) lists, and the documents' pairs as
        (document, pair) keys with their links."""
        n_a, n_b, groups, links = (np.zeros(len(texts), dtype=np.int64) for _ in range(4))
        digests = [""] * len(texts)
        some = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
        if not len(some):
            return n_a, n_b, groups, links, digests, np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = [(" " + texts[i]).encode() for i in some.tolist()]
        ends = np.cumsum([len(x) for x in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        first = np.append(0, ends[:-1])
        starts = self.starts_in(data, first)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, *map(pa.py_buffer, (np.append(starts, len(data)), data))]).dictionary_encode()
        numbers = self.number(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        of = np.searchsorted(first, starts, side="right") - 1
        # texts with a word that a side doesn't give back have no tokens
        good = np.bincount(of, weights=~self.same[numbers], minlength=len(some)) == 0
        numbers, of = numbers[good[of]], some[of[good[of]]]
        for out, values in zip((n_a, n_b, groups), self.sums):
            out += np.bincount(of, weights=values[numbers], minlength=len(texts)).astype(np.int64)
        told = self.texts[numbers].tolist()
        rows = some[good]
        for i, x, y in zip(rows.tolist(), np.searchsorted(of, rows).tolist(), np.searchsorted(of, rows, side="right").tolist()):
            digests[i] = hashlib.sha256(b";".join(told[x:y])).hexdigest()
        # each word of a document once, then each pair
        once, often = np.unique(of << 32 | numbers, return_counts=True)
        word = once & (1 << 32) - 1
        sizes = self.sizes[word]
        where = _ragged(self.starts[word], sizes)
        key = np.repeat(once >> 32 << 33, sizes) | self.pairs[where]
        times = np.repeat(often, sizes) * self.times[where]
        order = np.argsort(key)
        key, times = key[order], times[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
        key, times = key[begin], np.add.reduceat(times, begin) if len(begin) else times
        links += np.bincount(key >> 33, weights=times, minlength=len(texts)).astype(np.int64)
        return n_a, n_b, groups, links, digests, key, times


def _place(path: str) -> str:
    return path if os.path.isabs(path) else SparkFiles.get(path)


def _calls(batches, most: int):
    """(ids, texts) of consecutive rows, about ``most`` bytes each."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n = len(t or "")
            if held and held + n > most:
                yield ids, texts, held
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(t)
            held += n
    if ids:
        yield ids, texts, held


def blocks(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, model: str) -> DataFrame:
    """Rows of documents (pairs as numbers in their block's list, and links), and one
    row of each block (its distinct pairs, and in how many of its documents each is)."""
    kind = dict(docs.dtypes)[id_col]
    schema = (f"block long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pair array<int>, links array<int>, pairs array<long>, counts array<int>")

    def run(batches, id_type):
        aligner = Aligner.of(_place(vocabulary), _place(model))
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def ragged(keys, rows, values, kind_):
            cut = np.searchsorted(keys, np.arange(rows + 1) << 33)
            return pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(values, kind_))

        def finish():
            every = np.concatenate([x[-2] & (1 << 33) - 1 for _, x in held])
            told = pa.array(every).dictionary_encode()
            pairs, number, at = told.dictionary.to_numpy(), told.indices.to_numpy(), 0
            order = np.argsort(pairs)
            pairs, counts = pairs[order], np.bincount(number, minlength=len(pairs))[order]
            number = np.argsort(order)[number]
            for ids, (n_a, n_b, groups, links, digests, key, times) in held:
                n, mine = len(ids), number[at:at + len(key)]
                at += len(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array(ids, id_type), *map(pa.array, (n_a, n_b, groups, links)), pa.array(digests),
                     ragged(key, n, mine, pa.int32()), ragged(key, n, times, pa.int32()),
                     pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.nulls(1, id_type), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.string()),
                 pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())),
                 pa.array([pairs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int32()))], names=names)

        names = ["block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "links", "pairs", "counts"]
        for ids, texts, n in _calls(batches, CALL_BYTES):
            held.append((ids, aligner.align(texts)))
            size += n
            if size >= BLOCK_BYTES:
                yield from finish()
                block, held, size = block + 1, [], 0
        if held:
            yield from finish()

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(partial(run, id_type=id_type), schema))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
          model: str = MODEL) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): per document id_col, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256; and (a, b, count, best) of every linked pair of ids.

    The files must be readable by every executor (a path on all machines, or the
    bare name of a file given to ``SparkContext.addFile``).
    """
    told = freeze(blocks(docs, id_col, text_col, vocabulary, model), "blocks")
    lists = told.where("pairs is not null").select("block", "pairs", "counts")
    counts = (lists.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
              .groupBy(F.col("p.pairs").alias("key")).agg(F.sum("p.counts").alias("count")))
    counts = freeze(counts, "pair-counts")
    a_of = F.shiftright("key", 16)
    most = counts.groupBy(a_of.alias("a")).agg(F.max("count").alias("most"))
    pairs = (counts.withColumn("a", a_of).join(most, "a")
             .select("key", "a", F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("b"), "count", (F.col("count") == F.col("most")).alias("best")))
    back = (lists.select(F.col("block").alias("home"), F.posexplode("pairs").alias("k", "key"))
            .join(pairs.select("key", "count", "best"), "key").select("home", "k", "count", "best"))
    kind = dict(told.dtypes)["id"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = right.column("k").to_numpy()
        count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy()
        left = left.combine_chunks()
        number, links = (left.column(c).combine_chunks() for c in ("pair", "links"))
        cut = number.offsets.to_numpy()
        number, links = number.flatten().to_numpy(), links.flatten().to_numpy().astype(np.int64)
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[cut - cut[0]])
        return pa.table({"id": left.column("id"), **{c: left.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": total(links * best[number]), "count_sum": total(links * count[number]),
                         "groups_sha256": left.column("groups_sha256")})

    judged = (told.where("pairs is null").select("block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "links")
              .groupBy("block").cogroup(back.groupBy("home"))
              .applyInArrow(meet, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
    return judged.withColumnRenamed("id", id_col), pairs.select("a", "b", "count", "best")


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Both tokenizers' links in every document, judged by the counts of the whole corpus."""
    return align(read(spark, sf_dir, "documents"))[0]
