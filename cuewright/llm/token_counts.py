"""Token counts with a digest cache.

A text's key is the digest of its normalised content and that of the tokenizer's version. Normalised is what the tokenizer makes
equal before it splits: where its file says that it lower-cases and drops white space, A-Z become a-z, runs of ASCII white space
one blank, and none stands at the ends; texts with a special string, which is looked for before that, and texts of other tokenizers
stay as they are. Keys are joined to stored counts; the distinct contents that have none are encoded, once each, and their counts
are appended to the cache, a Parquet folder. A later call with the same cache encodes new contents only. A lost executor recomputes
its part; counts are appended in one committed write.

A worker remembers the counts of words: between two white space characters this kind of tokenizer never merges, so a text's
count is the sum over its words. Texts beyond U+024F or with control or special strings go to the library whole.

Null texts count as empty (no bytes, no tokens); null ids and repeated rows are kept as they are; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, drop, held, settle, shared_dir

#: Words that a worker remembers.
REMEMBERED = 400_000
LIMIT = 2_048
#: Digests that have no count yet, up to which they are sent to every task.
SENT = 100_000
# Texts whose words can be counted apart: no control characters (which some white space classes take in), no dotted capital I,
# nothing beyond U+024F and no special string.
_OTHER = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0İ]|[^\x00-ɏ]|<\\|")
# Fixed character classes up to U+024F: letters, numbers.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_L}]+|[{_N}]|[^{_L}{_N}]+")


class _Counts(dict):
    def __init__(self, made):
        super().__init__()
        self.made = made

    def __missing__(self, key):
        n = self.made(key)
        if len(self) >= REMEMBERED:
            self.clear()
        self[key] = n
        return n


def drops_case_and_space(path: str) -> bool:
    """Whether the file says that the tokenizer lower-cases and drops white space."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    return kind["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in str(kind["normalizer"]) and kind["pre_tokenizer"]["pretokenizers"][0].get("behavior") == "Removed"


def normalised(text: Column) -> Column:
    """What such a tokenizer makes equal, as far as that can't change a count; texts with a special string stay."""
    space = "\t\n\x0b\x0c\r"
    low = F.translate(text, string.ascii_uppercase + space, string.ascii_lowercase + " " * len(space))
    return F.when(F.contains(text, F.lit("<|")), text).otherwise(F.trim(F.regexp_replace(low, " {2,}", " ")))


class Counter:
    """Counts tokens as the library of the file does: .json by tokenizers, .model by sentencepiece."""

    def __init__(self, path: str):
        self.words = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: len(model.encode(text))
            return
        import tokenizers

        model = tokenizers.Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.whole = lambda text: len(model.encode(text, add_special_tokens=False).ids)
        if drops_case_and_space(path):
            pieces = _Counts(self.whole)
            self.words = _Counts(lambda word: sum(map(pieces.__getitem__, _PIECE.findall(word))))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.words is None or _OTHER.search(text):
            return self.whole(text)
        return sum(map(self.words.__getitem__, text.lower().split()))


def counter(path: str | None = None) -> Counter:
    """The counter of a tokenizer file, made once a worker."""
    import public_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    return held(("counter", path), lambda: Counter(path))


def version(path: str | None = None) -> str:
    """A digest of the tokenizer's file."""
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _stored(spark, cache: str, tokenizer: str) -> DataFrame:
    """The stored counts of a tokenizer by digest, settled, so that a join stands on plain shuffles and the rows of a digest that very
    many texts have can be split between tasks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    schema = "tokenizer string, digest binary, n_tokens long"
    all_of = spark.read.schema(schema).parquet(cache) if there else spark.createDataFrame([], schema)
    return settle(all_of.filter(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of each row. ``cache``: the folder of stored counts; by default one for this call only."""
    import public_tokenizers

    spark, own = df.sparkSession, cache is None
    path = path or public_tokenizers.path("word_bpe_49k.json")
    cache = cache or f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    tokenizer = version(path)
    raw = F.coalesce(text_col, F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), F.octet_length(raw).cast("long").alias("n_bytes"), (normalised(raw) if drops_case_and_space(path) else raw).alias("text"))
    docs = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    # The first of equal contents is found before the shuffle and after it, so one goes over the network once a task at most.
    misses, known = docs.select("digest", "text"), _stored(spark, cache, tokenizer)
    if known.isEmpty():
        misses = misses.dropDuplicates(["digest"])
    else:
        new = settle(docs.select("digest").distinct().join(known, "digest", "left_anti"))
        if new.count() <= SENT:  # so contents that are known stay where they are
            misses = misses.join(F.broadcast(new), "digest", "left_semi").dropDuplicates(["digest"])
        else:
            misses = misses.dropDuplicates(["digest"]).join(new, "digest", "left_semi")

    def make():
        work = counter(path).count
        return lambda texts: [[work(t) for t in texts]]

    made = append_columns(misses, ["text"], ["digest"], [("n_tokens", T.LongType())], make)
    made.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    out = docs.select("id", "n_bytes", "digest").join(_stored(spark, cache, tokenizer), "digest")
    if own:
        drop(spark, cache)
    return out.select("id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
