"""Helpers that several operators share."""

from __future__ import annotations

import io
import json
import os
import uuid
import zipfile
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.session import shared_folder

#: Rows and bytes of an Arrow batch; very long texts must not pile up in one batch.
TEXT_BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``text`` alone, a null text as empty; other columns cannot clash."""
    return df.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


_shipped: set[str] = set()


def ready_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound the rows and bytes that go to one at once.

    One text may have megabytes, so batches are small; the bounds are settings of the session
    and stay, as Spark reads them when a job starts. The package goes to the executors as
    a zip file in the shared folder, once per application, as any job's own code does.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[1]
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, str(file.relative_to(root.parent)))
        archive = f"{shared_folder(spark)}/ledgerstar/code-{uuid.uuid4().hex}/ledgerstar.zip"
        with File.create(archive) as stream:
            stream.write(packed.getvalue())
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def crc32_of_ids(ids: bytes) -> int:
    """Unsigned crc32 of 16-bit ids, each as a little-endian unsigned 32-bit integer."""
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


def in_set_share(column: Column) -> Column:
    """``crc32`` of an id as text modulo 4; the remainder 2 is held out of training."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(4))


class File:
    """Binary files on the file system that a URI names; used inside tasks.

    ``file:``, ``hdfs:`` and object-store URIs work alike. A task writes under a name that no
    other attempt uses, and only names that reach a committed index count as written.
    """

    @staticmethod
    def _resolve(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
        scheme, found, rest = uri.partition(":/")
        if not found or scheme == "file":  # "/x", "file:/x" and "file:///x" are one place
            uri = f"file:///{(rest if found else uri).lstrip('/')}"
        return pyarrow.fs.FileSystem.from_uri(uri)

    @classmethod
    def create(cls, uri: str) -> pa.NativeFile:
        system, path = cls._resolve(uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path)

    @classmethod
    def open(cls, uri: str) -> pa.NativeFile:
        system, path = cls._resolve(uri)
        return system.open_input_stream(path, buffer_size=1 << 20)

    @classmethod
    def open_at(cls, uri: str) -> pa.NativeFile:
        """For reads at offsets."""
        system, path = cls._resolve(uri)
        return system.open_input_file(path)


class _ByteCharacters(dict):
    """A character as byte-level tokenizers spell it, one character per byte of its UTF-8.

    Fixed rule: bytes that print stand for themselves, the others in turn for 256 and on.
    """

    _printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    _others = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - _printed))}

    def __missing__(self, character: str) -> str:
        spelled = "".join(chr(self._others.get(b, b)) for b in character.encode())
        self[character] = spelled
        return spelled


_SPELLED = _ByteCharacters()


class WordTokenizer:
    """Ids of whole texts by the ``tokenizers`` library, each word encoded once.

    The byte-level pattern never lets a token span a single space or line break between two
    characters that are not white space. Such texts are cut there, words seen before come from
    a dictionary of at most ``most_words``, and the library encodes the others. Any other text,
    and one that holds an added token such as an end mark, goes to the library whole, so the ids
    are always those of the library.
    """

    _of: dict[str, "WordTokenizer"] = {}

    def __init__(self, path: str, most_words: int = 1_100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Texts that hold one of these are cut there by the library, wherever it stands.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        parts = json.loads(self.tokenizer.to_str())
        kind = parts["pre_tokenizer"] or {}
        usual = kind.get("use_regex") and not kind.get("add_prefix_space")
        if parts["normalizer"] or kind.get("type") != "ByteLevel" or not usual:
            raise ValueError("not a byte-level tokenizer with the usual pattern")
        self.model = self.tokenizer.model
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit in 16 bits")
        self.most_words = most_words
        self.words: dict[str, bytes] = {}
        self.marks = dict(zip(",.", self._whole([",", "."])))

    @classmethod
    def of(cls, path: str) -> "WordTokenizer":
        """One per worker process, so that later tasks find the words of earlier ones."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H", e.ids).tobytes() for e in found]

    def _model(self, word: str) -> bytes:
        """Ids of " word" for a word of Latin letters, which the pattern leaves in one piece."""
        letters = word if word.isascii() else "".join(map(_SPELLED.__getitem__, word))
        spelled = _SPELLED[" "] + letters
        return array("H", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode words: letters by the model itself, a mark that follows them by its own id.

        All others go to the library in one text, a line each; only line breaks have the id
        that parts the lines.
        """
        known, others = self.words, []
        for word in words:
            if _letters(word):
                known[word] = self._model(word)
            elif word[-1] in self.marks and _letters(body := word[:-1]):
                if (ids := known.get(body)) is None:
                    ids = known[body] = self._model(body)
                known[word] = ids + self.marks[word[-1]]
            else:
                others.append(word)
        lines = [w if w[0] == "\n" else f"\n {w}" for w in others]
        [found] = self.tokenizer.encode_batch_fast(
            ["".join(lines) + "\n"], add_special_tokens=False
        )
        ids = array("H", found.ids)
        raw, line = ids.tobytes(), ids[0]
        ends = [2 * at for at, value in enumerate(ids) if value == line]
        known.update(
            (w, raw[a if w[0] == "\n" else a + 2 : b])
            for w, a, b in zip(others, ends, ends[1:], strict=False)
        )

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as 16-bit little-endian integers.

        Words are split and numbered by Arrow, so Python sees each different one once.
        """
        if not len(texts):
            return []
        known = self.words
        if len(known) > self.most_words:
            known.clear()
        # A word stands for "space and word", the first of a line for "line break and word".
        # Each text gets a line break in front, whose id is dropped again.
        lines = pc.replace_substring(texts, "\n", " \n")
        lines = pc.binary_join_element_wise("\n", lines, "").cast(pa.large_string())
        split = pc.split_pattern(lines, " ")
        numbered = split.values.dictionary_encode()
        number = numbered.indices.to_numpy()
        words = numbered.dictionary.to_pylist()
        found = list(map(known.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        # An edge that is white space needs the library's own view of the whole text.
        # So does a word with an added token, which would cut the shared lines of new words.
        odd = {
            w
            for w in missing
            if not (bare := w.removeprefix("\n"))
            or _spaced(bare)
            or any(content in bare for content in self.added)
        }
        if missing:
            if learn := [w for w in missing if w not in odd]:
                self._learn(learn)
            found = [known.get(w, b"") if ids is None else ids for w, ids in zip(words, found)]
        ids = np.frombuffer(b"".join(found), "<u2")
        ends = np.cumsum([len(i) // 2 for i in found])
        by_word = pa.LargeListArray.from_arrays(np.concatenate([[0], ends]), ids)
        taken = by_word.take(pa.array(number))
        # Where each text ends, by words and then by ids.
        stops = taken.offsets.to_numpy()[split.offsets.to_numpy()]
        raw = taken.values.to_numpy().tobytes()
        result = [raw[2 * a + 2 : 2 * b] for a, b in zip(stops.tolist(), stops[1:].tolist())]
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if odd:
            at = [i for i, w in enumerate(words) if w in odd]
            places = np.flatnonzero(np.isin(number, at))
            whole[np.searchsorted(split.offsets.to_numpy(), places, "right") - 1] = True
        rows = np.flatnonzero(whole).tolist()
        for row, ids in zip(rows, self._whole([texts[i].as_py() for i in rows])):
            result[row] = ids
        return result


def _letters(word: str) -> bool:
    """Only letters, and of scripts whose letters no version of Unicode disputes."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


def _spaced(word: str) -> bool:
    return word[0].isspace() or word[-1].isspace()


def single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that of large ones only one is opened at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def text_batches(
    batches: Iterator[pa.RecordBatch], size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Rows together until a batch has about ``size`` bytes."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.nbytes for b in waiting) >= size:
            yield pa.concat_batches(waiting)
            waiting = []
    if waiting:
        yield pa.concat_batches(waiting)
