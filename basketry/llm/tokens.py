"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on ids."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash
from .text import LOWER, per_process, ragged, slices, utf8

END_ID = 2
CACHE_PIECES = 600_000  # about 150 MB in a Python worker
CUT_BYTES = 1 << 21  # of text at once; a worker takes some 30 times that
_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_SPACE, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _BAR, _BEYOND, _LATIN = range(8)
_LATIN_ENDS = np.zeros((3, 256), bool)  # last bytes of the letters in _WORD, by first bytes C3, C4, C5
_LATIN_ENDS[:, 0x80:0xC0] = True
_LATIN_ENDS[[0, 0, 1], [0x97, 0xB7, 0xB0]] = False


def _kinds() -> np.ndarray:
    """The kind of each byte."""
    kind = np.full(256, _MARK, np.uint8)
    kind[list(b" \t\n\r")] = _SPACE
    kind[0x41:0x5B] = kind[0x61:0x7B] = _LETTER
    kind[0x30:0x3A] = _DIGIT
    kind[ord("'")], kind[ord("|")], kind[0x80:] = _APOSTROPHE, _BAR, _BEYOND
    return kind


def _cuts() -> np.ndarray:
    """Whether a piece starts between a byte of one kind and a byte of another, at 8 * kind + kind."""
    cut = np.zeros((8, 8), bool)
    cut[_SPACE, :] = cut[:, _SPACE] = True
    cut[_DIGIT, [_LETTER, _DIGIT, _MARK, _APOSTROPHE]] = True
    cut[[_LETTER, _MARK, _APOSTROPHE], _DIGIT] = True
    cut[[[_LETTER], [_LATIN]], [_MARK, _APOSTROPHE]] = cut[_MARK, _LETTER] = cut[_LATIN, _DIGIT] = True
    return cut.ravel()


_KIND, _CUT = _kinds(), _cuts()


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level BPE: bytes that print stay, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts without white space, and the first piece of each text and the number of all.

    A-Z are lower-cased, as the tokenizer does later on, unless they precede a character beyond ASCII, which may be a mark
    that joins the one case only, or the texts may hold one of the tokenizer's special tokens.
    """
    kind = _KIND[data]
    leads = np.flatnonzero(data[:-1] - np.uint8(0xC3) < 3)
    kind[leads[_LATIN_ENDS[data[leads] - 0xC3, data[leads + 1]]] + 1] = _LATIN
    kept = kind != _SPACE
    starts = np.ones(len(data), bool)
    starts[1:] = _CUT[kind[:-1] * np.uint8(8) + kind[1:]]
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(starts & kept)
    places = np.cumsum(kept, dtype=np.int32)
    ends = np.append(places[starts] - 1, places[-1:]).astype(np.int32)
    if not len(starts):
        return pa.array([], pa.string()), np.zeros(len(offsets), np.int64)
    if b"<|" not in data.tobytes():
        data = np.where(np.append(data[1:] < 0x80, True), LOWER[data], data)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[kept]))
    return pieces, np.searchsorted(starts, offsets)


class WordCache(dict):
    """Token ids of pieces of text, encoded once each.

    The tokenizer drops white space, takes digits one by one and cuts between letters and punctuation, so a text's
    ids are those of its pieces one after another.  Texts are cut at ASCII white space and between two characters of
    which one is a digit, or one a letter and the other punctuation, both ASCII; the first may also be a letter of
    ``_WORD``.  They are not cut after an apostrophe (``'s`` is one word to the tokenizer), beside a bar
    (``<|endoftext|>`` is one token) or at other characters, which may join their neighbours (in lower case they may
    end in a mark, which the tokenizer keeps together with a stop).  Words of the letters of ``_WORD`` go to the
    tokenizer's BPE model in lower case, since its normaliser and splitter leave them whole; other pieces take the
    whole way.  A full cache is emptied.
    """

    def __init__(self, path: str):
        import tokenizers

        super().__init__()
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters() | {ord("\n"): "\n"}
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.ids = np.zeros(0, np.int32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number

    def _learn(self) -> None:
        if not self.new:
            return
        plain = [p.isalpha() and (p.isascii() or _WORD.fullmatch(p) is not None) for p in self.new]
        words = "\n".join(compress(self.new, plain)).lower()
        spelled = iter(words.encode().decode("latin-1").translate(self.letters).split("\n"))
        tokenize, whole = self.model.tokenize, self.tokenizer.encode
        found = [
            [t.id for t in tokenize(next(spelled))] if known else whole(piece, add_special_tokens=False).ids
            for piece, known in zip(self.new, plain, strict=True)
        ]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        return self.encode_utf8(*utf8(pa.array(texts, pa.string())))

    def encode_utf8(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts given as bytes one after another, and offsets."""
        if len(self) > CACHE_PIECES:
            self._reset()
        pieces, first = cut_pieces(data, offsets)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        self._learn()
        lengths = self.lengths[numbers]
        ids = self.ids[ragged(self.starts[numbers], lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])[first]
        return ids, np.diff(upto)


def encoder(tokenizer: str, text: str, end_id: int):
    """A function for mapInArrow that puts column ``ids`` in the place of the text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = per_process(("WordCache", tokenizer), lambda: WordCache(tokenizer))
        for part, data, bounds in slices(batches, text, CUT_BYTES):
            at = part.schema.get_field_index(text)
            ids, counts = cache.encode_utf8(data, bounds)
            ends = np.cumsum(counts + 1)
            out = np.full(int(ends[-1]), end_id, np.int32)
            inside = np.ones(len(out), bool)
            inside[ends - 1] = False
            out[inside] = ids
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(out, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(1 - at), lists], ["id", "ids"])

    return encode


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    stripe_bytes: int = 16 << 20,
    index_rows: int = 1000,
) -> None:
    """Write (id, ids) as ORC in ascending order of the id, one file per range of ids.

    Each text's ids end with ``end_id``.  Integer columns are run-length encoded by the
    format; each ``index_rows`` rows have minimum, maximum and a Bloom filter of the id, so a reader
    of some ids skips stripes and rows, and stripes are read in parallel.  Null texts count as
    empty; null ids come first; repeated rows are written as often as they come.  Other columns
    are not read.  Nothing is appended to a path that exists.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    ranged = rows.repartitionByRange("id").sortWithinPartitions("id")
    (
        ranged.mapInArrow(encoder(tokenizer, "text", end_id), schema)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", "id")
        .orc(path)
    )


def read_token_ids(spark, path: str, id_type: T.DataType) -> DataFrame:
    """Rows (id, ids) as written; filters on the id are pushed to stripes and Bloom filters."""
    schema = T.StructType([T.StructField("id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return spark.read.schema(schema).orc(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        offsets = np.asarray(lists.offsets)
        values = np.asarray(lists.values).astype("<u4", copy=False)
        crc = [zlib.crc32(values[a:b].data) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        arrays = [batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64()), batch.column(2)]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "n_tokens", "ids_crc32", "file"])


def token_positions(spark, path: str, id_type: T.DataType) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) from the files at ``path``.

    ``start`` counts the ids of all rows before; of rows with one id, those with fewer ids come
    first.  A file's rows stand in order and files hold ranges, so starts are sums within a file
    plus the totals of the files before it.
    """
    read = read_token_ids(spark, path, id_type).withColumn("file", F.col("_metadata.file_name"))
    fields = [T.StructField("id", id_type), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids_crc32", T.LongType()), T.StructField("file", T.StringType())]
    rows = stash(read.mapInArrow(_digests, T.StructType(fields)), "token-digests")
    files = rows.groupBy("file").agg(F.min(F.struct("id")).alias("least"), F.max(F.struct("id")).alias("most"), F.sum("n_tokens").alias("n"))
    before = W.orderBy("least", "most").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = W.partitionBy("file").orderBy("id", "n_tokens", "ids_crc32").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return rows.join(files, "file").select("id", start.alias("start"), "n_tokens", "ids_crc32")
