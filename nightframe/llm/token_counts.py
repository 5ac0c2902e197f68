"""Token counts by a cache of digests.

A text's count depends on its content and the tokenizer, so counts are kept under the digests of both in a folder of
Parquet files that lasts between runs. A run digests all texts where they lie, joins the digests with the stored counts, encodes
each different text that has none once, and appends these counts. Texts whose counts are known, and the other copies of
one that isn't, are neither encoded nor shuffled as texts, when the missing digests are few enough to be sent to every
task; else different texts are shuffled once, compressed.

Content is normalised as far as the tokenizer itself does so: null is the empty text, and where its own
normaliser writes a space as ``SPACE_MARK`` and changes nothing else, so does the digest. Null and empty texts have no tokens.
Texts of any length are encoded whole. Repeated rows and ids each get their row; extra columns are ignored. An empty table has no rows,
and its run appends nothing. Several runs may append at once: each writes a folder of its own, and a count that two of them have
stored is the same in both.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.llm.common import stored
from nightframe.sources.sinks import exists

#: What a sentencepiece model writes for a space. Fixed by the format.
SPACE_MARK = "▁"
#: Missing digests of this size at most are sent to every task.
SENT_BYTES = 1 << 20
#: Words whose counts a task keeps, and digests it remembers; longer words are counted each time.
WORDS = 1 << 19
WORD_LENGTH = 64

_CACHE = "content binary, n_tokens long"


class Tokenizer:
    """Counts of a vocabulary file: ``.json`` by tokenizers, ``.model`` by sentencepiece. Nothing is added, cut or filled up."""

    def __init__(self, file: str) -> None:
        import public_tokenizers

        path = public_tokenizers.path(file)
        with open(path, "rb") as f:
            content = f.read()
        self.words: dict[str, int] = {}
        self.marks_spaces = self.by_words = False
        if file.endswith(".json"):
            import tokenizers

            self.library = f"tokenizers {tokenizers.__version__}"
            model = tokenizers.Tokenizer.from_file(path)
            model.no_padding()
            model.no_truncation()
            self._whole = lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            self.library = f"sentencepiece {sentencepiece.__version__}"
            model = sentencepiece.SentencePieceProcessor(model_file=path, add_bos=False, add_eos=False)
            self._whole = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            probe = " a  ▁b\tﬁİ "
            self.marks_spaces = model.normalize(probe) == SPACE_MARK + probe.replace(" ", SPACE_MARK)
            # no piece goes on after a word's end, so words can be encoded one by one
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            inside = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
            self.by_words = self.marks_spaces and not any(inside.search(p) for p in pieces)
            self.alone = len(model.encode("a ")) - len(model.encode("a"))
        self.version = hashlib.sha256(f"{self.library}\0count\0".encode() + content).hexdigest()

    def normalised(self, text: Column) -> Column:
        text = F.coalesce(text.cast("string"), F.lit(""))
        return F.replace(text, F.lit(" "), F.lit(SPACE_MARK)) if self.marks_spaces else text

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        if not self.by_words:
            return self._whole(texts)
        cut = [_words(t) for t in texts]
        known = self.words
        new = list({w for words in cut for w in words if w not in known and len(w) <= WORD_LENGTH})
        if len(known) + len(new) > WORDS:
            known.clear()
            new = list({w for words in cut for w in words if len(w) <= WORD_LENGTH})
        # the model puts a mark before each text, as the one that is cut off here
        known.update(zip(new, self._whole([w[1:] for w in new]), strict=True))
        if SPACE_MARK in known:
            known[SPACE_MARK] = self.alone
        return [sum(known[w] if w in known else self._whole([w[1:]])[0] for w in words) for words in cut]


def _words(text: str) -> list[str]:
    """Runs of marks, each with what follows up to the next run; marks at the end are a word too."""
    return _WORD.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []


_WORD = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*")

_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(file: str) -> Tokenizer:
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = Tokenizer(file)
    return _TOKENIZERS[file]


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``content, n_tokens`` stored for a tokenizer's version, each digest once."""
    folder = f"{cache.rstrip('/')}/tokenizer={version}"
    if not exists(spark, folder):
        return spark.createDataFrame([], _CACHE)
    found = spark.read.schema(_CACHE).option("recursiveFileLookup", True).parquet(folder)
    return found.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``content, text`` with each digest once, as far as the task remembers, and its text compressed."""
    codec = pa.Codec("zstd", compression_level=1)
    seen: set[bytes] = set()
    for batch in batches:
        contents, texts, sizes = [], [], []
        for content, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if content not in seen:
                if len(seen) >= WORDS:
                    seen.clear()
                seen.add(content)
                data = text.as_py()
                contents.append(content)
                sizes.append(len(data))
                texts.append(codec.compress(data, asbytes=True) if data else b"")
        columns = [pa.array(contents, pa.binary()), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["content", "packed", "size"])


def _counts(file: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``content, n_tokens`` from ``content, packed, size``; of a digest that occurs again only the first is encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, codec = tokenizer(file), pa.Codec("zstd")
        seen: set[bytes] = set()
        for batch in batches:
            contents, counts, held, size = [], [], [], 0
            for row in range(batch.num_rows):
                content, packed, n = (batch.column(i)[row].as_py() for i in range(3))
                if content in seen:
                    continue
                if len(seen) >= WORDS:
                    seen.clear()
                seen.add(content)
                contents.append(content)
                held.append(codec.decompress(packed, n, asbytes=True).decode("utf-8", "replace") if n else "")
                size += n
                if size >= 1 << 22:  # texts in memory at once
                    counts += model.count(held)
                    held, size = [], 0
            counts += model.count(held)
            yield pa.RecordBatch.from_arrays([pa.array(contents, pa.binary()), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, cache: str, file: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row; counts that weren't in the folder ``cache`` are added to it."""
    spark = docs.sparkSession
    model = tokenizer(file)
    content = F.unhex(F.sha2(model.normalised(F.col(f"`{text}`")), 256))
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    digests = docs.select(F.col(f"`{id}`").alias("id"), F.octet_length(plain).cast("long").alias("n_bytes"), content.alias("content"))
    digests = stored(digests, "token-digests")
    folder = f"{cache.rstrip('/')}/tokenizer={model.version}"
    missing = digests.select("content").distinct().join(cached(spark, cache, model.version), "content", "left_anti")
    missing = stored(missing, "token-misses")
    misses = missing.count()
    if misses:
        texts = docs.select(content.alias("content"), plain.cast("binary").alias("text"))
        few = misses * 32 <= SENT_BYTES
        if few:
            texts = texts.join(F.broadcast(missing), "content", "left_semi")
        # all texts of a digest in one task, which encodes the first
        packed = texts.mapInArrow(_first_of_task, "content binary, packed binary, size long").repartition("content")
        if not few:
            packed = packed.join(missing, "content", "left_semi")
        packed.mapInArrow(_counts(file), _CACHE).write.parquet(f"{folder}/{uuid.uuid4().hex}")
    found = digests.join(cached(spark, cache, model.version), "content")
    return found.select(F.col("id").alias(id), "n_bytes", "n_tokens")
