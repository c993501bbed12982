"""SentencePiece models run by the tokenizers library.

The model file's protobuf is read field by field; its pieces, scores, types,
trainer and normaliser settings are rebuilt as a ``tokenizers`` pipeline:

* normaliser: the precompiled character map (if any), removal of extra spaces
  (if set), the dummy prefix and the space marker U+2581;
* unigram models: pieces with their scores and byte fallback; BPE models: the
  merges that lead to each piece, ranked by its score, with byte fallback and
  fused unknowns;
* if a model's pieces carry the marker only at their start, texts are cut
  before runs of markers, which changes no result (no merge crosses such a
  cut) and lets the library reuse the pieces of repeated words.

A worker checks its rebuilt tokenizer against the sentencepiece library on
``PROBES`` before it encodes, and fails on any difference. Every row is also
decoded again and compared with its text (``round_trip``).

Batches are encoded by the library's threads (``threads`` of them).

Defined results: a null text has null ids, count and round trip; an empty text
has no ids. Control pieces in a text are ordinary text. Repeated rows are
encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public model file is, unless a caller names another.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Texts of one ``encode_batch`` call, in characters.
CALL_CHARS = 1 << 20
PROBES = ("Hello world", " two  spaces ", "tabs\tand\nlines\r\n", "naïve café — 東京 🙂", "a▁b", "<s></s><unk>",
          "1234567 0x1F", "", " ", " x", "word" * 50, "ÀÉÎ ß ç", "▁▁ a", "\x00\x01")

# Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Model types of the trainer settings (fixed values).
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of every field of a protobuf message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        elif wire == 2:
            size = number()
            yield key >> 3, data[at:at + size]
            at += size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size
        else:
            raise ValueError(f"not a model file: wire type {wire}")


@dataclass
class PieceModel:
    """What a model file says that matters for encoding and decoding."""

    pieces: list = field(default_factory=list)      # (text, score, type)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def parse_model(data: bytes) -> PieceModel:
    """Read a model file's bytes (field numbers of its public format)."""
    m = PieceModel()
    for number, value in fields(data):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL, **dict(fields(value))}
            m.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            trainer = dict(fields(value))
            m.kind = trainer.get(3, UNIGRAM)
            m.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            norm = dict(fields(value))
            m.charsmap = norm.get(2, b"")
            m.add_dummy_prefix = bool(norm.get(3, 1))
            m.remove_extra_spaces = bool(norm.get(4, 1))
            m.escape_spaces = bool(norm.get(5, 1))
    unknown = [i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN]
    m.unk_id = unknown[0] if unknown else 0
    if m.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {m.kind} is neither unigram nor BPE")
    if not m.escape_spaces:
        raise ValueError("models that do not escape spaces are not supported")
    return m


def merges(m: PieceModel) -> list[tuple[str, str]]:
    """BPE merges in rank order: a piece's score ranks the merges that make it."""
    usable = {text: (-score, i) for i, (text, score, kind) in enumerate(m.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for text, rank in usable.items():
        cuts = [(text[:i], text[i:]) for i in range(1, len(text)) if text[:i] in usable and text[i:] in usable]
        found += [(rank, usable[a][1], usable[b][1], a, b) for a, b in cuts]
    found.sort()
    return [(a, b) for *_, a, b in found]


def build(m: PieceModel):
    """The ``tokenizers`` object of a parsed model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if m.kind == UNIGRAM:
        model = models.Unigram([(t, s if k != USER_DEFINED else s) for t, s, k in m.pieces], m.unk_id, m.byte_fallback)
    else:
        vocab = {t: i for i, (t, _, _) in enumerate(m.pieces)}
        model = models.BPE(vocab=vocab, merges=merges(m), unk_token=m.pieces[m.unk_id][0],
                           fuse_unk=True, byte_fallback=m.byte_fallback)
    tok = Tokenizer(model)
    steps = []
    if m.charsmap:
        steps.append(normalizers.Precompiled(m.charsmap))
    if m.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    marked = [t for t, _, k in m.pieces if MARK in t and k in (NORMAL, USER_DEFINED)]
    if all(MARK not in t.lstrip(MARK) for t in marked):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    tok.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if m.add_dummy_prefix else []))
    return tok


def check_parity(tok, data: bytes, texts=PROBES) -> None:
    """Raise unless the rebuilt tokenizer gives the sentencepiece library's ids."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in texts:
        want, got = own.encode(text), tok.encode(text, add_special_tokens=False).ids
        if list(want) != list(got):
            raise ValueError(f"ids differ from the model's own library for {text!r}: {want} and {got}")


_LOADED: dict = {}


def load(path: str, threads: int = 1):
    """The checked tokenizer of a model file; one per worker process."""
    if path not in _LOADED:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        with open(path, "rb") as f:
            data = f.read()
        model = parse_model(data)
        tok = build(model)
        check_parity(tok, data)
        _LOADED[path] = tok, model
    return _LOADED[path]


def normalised(text: str, model: PieceModel) -> str:
    """What decoding gives back, for models without a character map."""
    if model.remove_extra_spaces:
        text = " ".join(x for x in text.split(" ") if x)
    return text.replace(MARK, " ")


def _slices(sizes) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``CALL_CHARS`` characters."""
    first = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > CALL_CHARS:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)


def encode_texts(texts: list, path: str, threads: int = 1, decode: bool = True) -> Iterator[tuple]:
    """(ids, decoded text) of every text; (None, None) for a null."""
    tok, model = load(path, threads)
    for a, b in _slices([len(t or "") for t in texts]):
        part = texts[a:b]
        # cutting first lets long texts share the threads and the word cache
        got = [e.ids for e in tok.encode_batch_fast([t or "" for t in part], add_special_tokens=False)]
        back = tok.decode_batch(got, skip_special_tokens=False) if decode else [None] * len(part)
        for text, ids, out in zip(part, got, back):
            yield (None, None) if text is None else (ids, out)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL,
           threads: int = 2) -> DataFrame:
    """(id_col, ids array<int>, n_tokens, round_trip) of every row.

    ``model_path`` must be readable by every executor (a path on all machines,
    or the bare name of a file given to ``SparkContext.addFile``).
    """
    def run(batches):
        path = model_path if os.path.isabs(model_path) else SparkFiles.get(model_path)
        _, model = load(path, threads)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for a, b in _slices(sizes):
                # a slice's ids become arrays before the next one is encoded
                texts = batch.column(1).slice(a, b - a).to_pylist()
                ids, n, same = [], [], []
                for text, (got, back) in zip(texts, encode_texts(texts, path, threads)):
                    ids.append(got)
                    n.append(None if got is None else len(got))
                    same.append(None if got is None else back == normalised(text, model))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32())), pa.array(n, pa.int64()),
                     pa.array(same, pa.bool_())], ["id", "ids", "n_tokens", "round_trip"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, ids array<int>, n_tokens long, round_trip boolean")
            .withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, id_col: str = "doc_id", model_path: str = MODEL, threads: int = 2) -> DataFrame:
    """(id_col, text) of rows with ``ids``; null ids give a null text."""
    def run(batches):
        path = model_path if os.path.isabs(model_path) else SparkFiles.get(model_path)
        tok, _ = load(path, threads)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            texts = tok.decode_batch([x or [] for x in lists], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if x is None else t for x, t in zip(lists, texts)], pa.string())],
                ["id", "text"])

    kind = dict(encoded.dtypes)[id_col]
    return (encoded.select(F.col(id_col).alias("id"), "ids").mapInArrow(run, f"id {kind}, text string")
            .withColumnRenamed("id", id_col))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every document's token count, token checksum and round trip."""
    from sitegauge.llm.tables import read
    return (encode(read(spark, sf_dir, "documents"))
            .select("doc_id", "n_tokens", F.xxhash64("ids").alias("ids_hash"), "round_trip"))
