"""Helpers shared by the training-data operators.

``words``        the word rule of every contract: maximal runs of characters other than ASCII white space
``materialize``  write an intermediate table to the cluster's shared folder and read it back
``WordEncoder``  tokenizers-library ids of whole texts, one BPE call per *distinct* word of a worker
"""

from __future__ import annotations

import array
import gc
import re
import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession

from eventide.session import checkpoint_dir

#: Fixed value of the contracts: characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
#: The same rule as a Java / RE2 pattern.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes (null: none).  bytes.split() splits on exactly SPACES."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which the driver and all executors share."""
    base = checkpoint_dir(spark).rstrip("/")
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base
    return f"{base}/eventide-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and reread it: cuts lineage, survives lost executors,
    and gives the planner measured sizes (so it broadcasts a side only when it is small)."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner delete the shuffle files of jobs that are done (it acts on collected plans)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process (models are loaded once, not once per task)."""
    return sys.modules.setdefault("_eventide_llm_cache", types.ModuleType("_eventide_llm_cache")).__dict__


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_chars() -> dict[int, str]:
    """Byte-level BPE writes every byte as one printable character: itself, or the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _lower_bytes() -> bytes:
    """Table that lower-cases the bytes of Latin-1 letters in UTF-8 (0xC3 and a second byte) and ASCII."""
    table = bytearray(range(256))
    for b in [*range(0x41, 0x5B), *range(0x80, 0x97), *range(0x98, 0x9F)]:
        table[b] += 0x20
    return bytes(table)


class WordEncoder(dict):
    """word (bytes) -> its token ids as little-endian uint32 bytes, filled on demand.

    The tokenizer drops white space and never merges across it, so a text's ids are its words' ids in order.
    Words of plain Latin letters with an optional run of ASCII marks behind them take the model's BPE directly for the
    letters (the tokenizer splits there; no apostrophe, which starts parts like 's, and no <, which starts control
    strings); all others go through the whole tokenizer.  Two generations of at most ``limit`` words each are held: a
    full one replaces the older, and words still in use come over from it, so memory is bounded while results stay
    the same.
    """

    plain = re.compile(rb"([A-Za-z]*(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][A-Za-z]*)*)([!-&(-/:;=-@\[-`{-~]*)")
    lower = _lower_bytes()

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.limit, self.table = self.tokenizer.model, limit, _byte_chars()
        self.older, self.marks = {}, {}

    def _ids(self, word: str) -> bytes:
        return array.array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            m = self.plain.fullmatch(word)
            if m is None:
                ids = self._ids(word.decode("utf-8", "replace"))
            else:
                letters, marks = m.groups()
                low = letters.translate(self.lower)
                if low == word:
                    ids = self._plain(low)
                else:
                    ids = self[low] if low else b""
                    if marks:
                        tail = self.marks.get(marks)
                        ids += self._marks(marks) if tail is None else tail
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _plain(self, low: bytes) -> bytes:
        chars = low.decode() if low.isascii() else low.decode("latin-1").translate(self.table)
        return array.array("I", [t.id for t in self.model.tokenize(chars)]).tobytes()

    def _marks(self, marks: bytes) -> bytes:
        ids = self._ids(marks.decode())
        if len(marks) <= 64 and len(self.marks) < self.limit:
            self.marks[marks] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, words(text)))


def word_encoder(path: str) -> WordEncoder:
    cache = worker_cache()
    if path not in cache:
        cache[path] = WordEncoder(path)
    return cache[path]
