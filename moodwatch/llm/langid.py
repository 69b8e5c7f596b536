"""Language identification by compression.

Each language has a zstandard raw-content dictionary: normalised text of a bounded
sample of labelled rows.  A text is compressed, block by block, with every dictionary;
the language with the smallest sum is chosen.  A narrow margin to the second language
rejects the text.

Normalised text is lower case words of letters with single blanks.  Two things keep the
sizes comparable where a compressor has little to say: a text most of whose words repeat
is reduced to its different words (else the repeats are all that is left to encode), and
a text shorter than ``LEAST`` bytes is repeated (else no compressed block beats the plain
one, and all languages tie).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass, kept, stored

#: the sample the dictionaries are made of: rows a language, characters a row, bytes a dictionary; with many
#: languages the dictionaries are smaller, so that all of them together have ``ALL_BYTES`` at most
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES, ALL_BYTES = 500, 4096, 256 << 10, 64 << 20
BLOCK, LEAST, LEVEL = 4096, 256, 6
#: texts whose best size is within this share of the second are rejected
NARROW = 0.02
UNDETERMINED = "und"
NO_LETTER = re.compile(r"[\W\d_]+")

def normalise(text: str) -> bytes:
    if not any(map(str.isalpha, text)):  # numerals such as one half are word characters, but no letters
        return b"  "
    words = NO_LETTER.sub(" ", text.lower()).split()
    different = dict.fromkeys(words)
    return (" " + " ".join(different if 2 * len(different) < len(words) else words) + " ").encode()


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionaries by language, from rows with a language and a text that aren't held out.

    The sample is drawn by a hash, so it doesn't depend on the order of rows: about twice
    ``SAMPLE_ROWS`` rows a language pass a threshold taken from the language's count, and
    the first of them are kept."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(
        F.col("t").isNotNull() & F.col("l").isNotNull() & ~held_out(F.col("i")))
    counts = stored(rows.groupBy("l").agg(F.count("*").alias("n")), "languages")
    most = min(DICTIONARY_BYTES, ALL_BYTES // max(1, counts.count()))
    drawn = F.pmod(F.xxhash64("i", "t"), F.lit(1 << 20)) < (1 << 20) * 2.0 * SAMPLE_ROWS / F.col("n")
    sample = (rows.join(counts, "l").where(drawn).select("l", F.xxhash64("i", "t").alias("h"), F.substring("t", 1, SAMPLE_CHARS).alias("t"))
              .withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "t")))
              .where(F.col("k") <= SAMPLE_ROWS))
    texts: dict[str, bytes] = {}
    # SAMPLE_ROWS short texts a language pass through, one part at a time
    for r in sample.orderBy("l", "k").toLocalIterator():
        if len(texts.get(r.l, b"")) < most:
            texts[r.l] = (texts.get(r.l, b"") + normalise(r.t))[:most]
    return {lang: t for lang, t in texts.items() if t.strip()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z
        self.coders = []
        for lang, content in sorted(dictionaries.items()):
            settings = z.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(content), source_size=BLOCK, window_log=20, write_content_size=False,
                write_checksum=False, write_dict_id=False)
            words = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=settings)
            self.coders.append((lang, z.ZstdCompressor(compression_params=settings, dict_data=words)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, margin); ``und`` and 0 for no letter or no learned language."""
        content = normalise(text or "")
        if not self.coders or not content.strip():
            return UNDETERMINED, 0.0
        if len(content) < LEAST:
            content *= 2 * LEAST // len(content)
        blocks = [content[k:k + BLOCK] for k in range(0, len(content), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.coders)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def _classifier(dictionaries: dict[str, bytes]) -> Classifier:
    """One classifier a worker for equal dictionaries."""
    return kept("langid", hash(tuple(sorted(dictionaries.items()))), lambda: Classifier(dictionaries))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row.

    ``score`` is the margin, 0 to 1.  A null text, an empty one and one without a letter are
    ``und`` with score 0 and not accepted.  Equal sizes go to the language that sorts first,
    with score 0.  Null ids and repeated rows are classified like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # ALL_BYTES at most

    def make():
        classify = _classifier(shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [classify(t) for t in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64()),
                 pa.array([x[0] != UNDETERMINED and x[1] >= NARROW for x in found], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"])

        return work

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))
    return arrow_pass(rows, ["doc_id", "held_out", "text"],
                      "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean", make, keep="langid")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    at = docs.columns.index(text_col)

    def make():
        classify = _classifier(shared.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [classify(t) for t in batch.column(at).to_pylist()]
            return batch.filter(pa.array([x[0] != UNDETERMINED and x[1] >= NARROW for x in found], pa.bool_()))

        return work

    return arrow_pass(docs, docs.columns, docs.schema, make, keep="langid")
