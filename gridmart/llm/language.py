"""Language by compression: the dictionary that packs a text best names its language."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.llm.common import map_arrow, map_batches

UNKNOWN = "und"

# The training sample: about so many documents of a language, and so many bytes of raw
# content. The result is broadcast: its size is bounded by languages times bytes.
SAMPLE_DOCS = 600
DICTIONARY_BYTES = 512 * 1024

# Greedy parsing with level 3 tables; finer levels pack no better for this purpose.
LEVEL = 3

# Texts are packed in spans of about so many bytes, each on its own, and the sizes summed:
# every span leans on the dictionary, and whole bytes of many spans tell finer margins.
SPAN = 96

# A text of SHORT bytes or more is rejected if the second best language needs at most this
# share more bytes than the best. Texts without letters are always rejected.
MIN_MARGIN = 0.02
SHORT = 512

# At most so many bytes of dictionaries in all, however many languages there are.
ALL_BYTES = 64 << 20

# Counts of so many languages are broadcast; of more they are joined by shuffles.
MANY = 1 << 16

# Texts of a few words may tie: then a code length in bits decides between the languages that do.
# Letters and their contexts in the code length, the weight of a shorter context, and the
# share kept for letters that a language has not shown. Letters coded at once are bounded.
ORDER = 4
_BACK = 4.0
_NEW = 1e-3
_CODED = 1 << 16

_NO_WORD = re.compile(r"[\W\d_]+")


def _plain(text: str | None) -> bytes:
    """Letters in lower case, runs of other characters as one blank."""
    return _NO_WORD.sub(" ", (text or "").lower()).strip().encode("utf-8", "surrogatepass")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Every third document by checksum of its id; never learned from."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 3 == 1


def learn(
    docs: DataFrame, sample: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """Raw dictionary content of each language, from documents that are not held out.

    A bounded sample: of each language the ``sample`` documents with the smallest hashes
    of their ids, which are spread over the whole table, and of these texts, in that
    order, the first ``size`` bytes of letters. Languages are counted first, so the
    sample is cut before it is sorted.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    order = F.xxhash64("doc_id", "text")
    near = F.pmod(order, F.lit(1 << 20))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    share = near * F.col("n") < F.lit(2 * sample << 20)
    languages_found = counts.count()
    if languages_found <= MANY:
        counts = F.broadcast(counts)
    some = labelled.select("lang", "text", "doc_id").join(counts, "lang").filter(share)
    best = Window.partitionBy("lang").orderBy(near, order)
    some = some.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= sample)
    # Only letters that a dictionary has room for leave Spark.
    letters = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " "))
    some = some.select("lang", "place", letters.alias("letters"))
    before = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    size = min(size, ALL_BYTES // max(1, languages_found))
    some = some.withColumn("start", F.coalesce(F.sum(F.length("letters")).over(before), F.lit(0)))
    room = F.lit(size) - F.col("start")
    some = some.filter(room > 0).select(
        "lang", "place", F.substring("letters", F.lit(1), room.cast("int")).alias("letters")
    )
    found: dict[str, bytes] = {}
    for row in some.orderBy("lang", "place").toLocalIterator():
        have = found.setdefault(row["lang"], b"")
        if len(have) < size:
            found[row["lang"]] = have + _plain(row["letters"])[: size - len(have)] + b" "
    return {lang: content for lang, content in found.items() if content.strip()}


def _letters(text: str) -> np.ndarray:
    """Code points; never 0."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + 1


def _grams(letters: np.ndarray) -> list[np.ndarray]:
    """Names of the 1 to ORDER letters that end at each place; 0 where there are fewer."""
    names = [letters]
    for n in range(1, ORDER):
        longer = np.zeros_like(letters)
        longer[n:] = names[-1][n - 1 : -1] * np.uint64(0x9E3779B97F4A7C15) + letters[n:]
        names.append(longer)
    return names


def _tables(content: bytes) -> tuple[int, list[tuple[np.ndarray, np.ndarray]]]:
    """The number of letters, and the names and counts of the 1 to ORDER letters in a row."""
    letters = _letters(content.decode("utf-8", "ignore"))
    return len(letters), [
        np.unique(names[n:], return_counts=True) for n, names in enumerate(_grams(letters))
    ]


class Letters:
    """What a letter costs under a language's dictionary, after up to ORDER - 1 others."""

    def __init__(self, total: int, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.total = total
        self.tables = tables

    def counts(self, n: int, names: np.ndarray) -> np.ndarray:
        known, count = self.tables[n]
        if not len(known):
            return np.zeros(len(names))
        at = np.minimum(np.searchsorted(known, names), len(known) - 1)
        return np.where(known[at] == names, count[at], 0.0)

    def bits(self, names: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each letter, and whether it was seen; ``place`` is that in its text."""
        seen = [self.counts(n, part) for n, part in enumerate(names)]
        chance = (1 - _NEW) * seen[0] / max(self.total, 1) + _NEW / (1 << 17)
        for n in range(1, ORDER):
            context = np.zeros(len(place))
            context[1:] = seen[n - 1][:-1]
            longer = (seen[n] + _BACK * chance) / (context + _BACK)
            chance = np.where(place >= n, longer, chance)
        return -np.log2(chance), seen[0] > 0


class Coder:
    """Packed sizes of a text under each language's dictionary."""

    def __init__(
        self,
        contents: dict[str, bytes],
        tables: list[tuple] | None = None,
        level: int = LEVEL,
    ):
        self.languages = sorted(contents)
        if tables is None:
            tables = [_tables(contents[language]) for language in self.languages]
        self.letters = [Letters(*table) for table in tables]
        self.coders = []
        for language in self.languages:
            dictionary = zstandard.ZstdCompressionDict(
                contents[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            parameters = zstandard.ZstdCompressionParameters.from_level(
                level,
                window_log=20,
                strategy=zstandard.STRATEGY_GREEDY,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            self.coders.append(
                zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)
            )

    def sizes(self, text: bytes) -> list[int]:
        """The packed bytes of all spans of a text, by language."""
        sums = [0] * len(self.coders)
        for span in _spans(text):
            for i, coder in enumerate(self.coders):
                sums[i] += len(coder.compress(span))
        return sums

    def code_lengths(self, texts: list[bytes]) -> list[list[float]]:
        """Bytes, not whole, that each language needs for each text; none if it shows no
        letter that was learned from. A text's lengths do not depend on the others."""
        found: list[list[float]] = []
        parts = [_letters(f" {text.decode('utf-8', 'surrogatepass')} ") for text in texts]
        first = 0
        while first < len(parts):
            last, size = first + 1, len(parts[first])
            while last < len(parts) and size + len(parts[last]) <= _CODED:
                size += len(parts[last])
                last += 1
            lengths = np.array([len(part) for part in parts[first:last]])
            start = np.cumsum(lengths) - lengths
            letters = np.concatenate(parts[first:last])
            place = np.arange(size) - np.repeat(start, lengths)
            names = _grams(letters)
            word = letters != ord(" ") + 1
            known = np.zeros(len(lengths), bool)
            sums = []
            for one in self.letters:
                bits, seen = one.bits(names, place)
                sums.append(np.add.reduceat(np.where(place > 0, bits, 0.0), start) / 8)
                known |= np.logical_or.reduceat(seen & word, start)
            every = np.stack(sums, 1).tolist()
            found += [sizes if ok else [] for sizes, ok in zip(every, known.tolist())]
            first = last
        return found

    def judge(
        self, texts: list[str | None], margin: float = MIN_MARGIN
    ) -> list[tuple[str, float, float, bool]]:
        """The language, a score from 0 to 1, the margin over the second best, and whether
        the text is rejected.

        The language with the smallest packed size wins, and the score is its share if a
        byte more halves a language's chance. Of languages that tie the one with the
        smallest code length wins, of equal ones the first by name; a text that ties and
        shows no letter that was learned from is ``und``.
        """
        found = [(UNKNOWN, 0.0, 0.0, True)] * len(texts)
        if not self.coders:
            return found
        plain = [_plain(text) for text in texts]
        tied = []
        for i, text in enumerate(plain):
            if text:
                sizes = self.sizes(text)
                best = min(sizes)
                if sizes.count(best) > 1 or len(sizes) == 1:
                    tied.append((i, sizes))
                else:
                    over = (sorted(sizes)[1] - best) / best
                    found[i] = (
                        self.languages[sizes.index(best)],
                        _share(sizes),
                        over,
                        len(text) >= SHORT and over <= margin,
                    )
        for (i, sizes), bits in zip(tied, self.code_lengths([plain[i] for i, _ in tied])):
            if bits:
                best = min(sizes)
                among = [(b, name) for size, b, name in zip(sizes, bits, self.languages) if size == best]
                least, name = min(among)
                alike = len(plain[i]) >= SHORT or sum(b == least for b, _ in among) > 1
                alone = len(sizes) == 1
                share = _share([b for b, _ in among])
                found[i] = (name, share, float(alone), alike and not alone)
        return found


def _share(sizes: list[float]) -> float:
    best = min(sizes)
    return 1.0 / sum(2.0 ** max(best - size, -60) for size in sizes)


def _spans(text: bytes) -> list[bytes]:
    """A text cut at blanks, or inside a longer word, into spans of at most SPAN bytes."""
    spans, start = [], 0
    while start < len(text):
        end = min(len(text), start + SPAN)
        if end < len(text):
            blank = text.rfind(b" ", start + 1, end)
            end = blank if blank > start else end
        spans.append(text[start:end])
        start = end
    return spans


def _learned(spark: SparkSession, docs: DataFrame):
    """Broadcast dictionaries and letter tables; both are bounded by the sample.

    Plain values only: a broadcast names classes by their module, which workers may lack.
    """
    contents = learn(docs)
    tables = [_tables(contents[language]) for language in sorted(contents)]
    return spark.sparkContext.broadcast((contents, tables))


def languages(docs: DataFrame, margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin and rejected of every whole text.

    lang_pred is a learned language, ``und`` if the text is null or has no letters or
    nothing could be learned, or if all sizes tie and none of its letters was learned from.
    Rejected: ``und``, texts of SHORT bytes or more whose margin is not above ``margin`` (0
    if languages tie), and shorter ones that tie in code length too. Ties go to the smaller
    code length, then to the first name.
    Only text decides; null labels are not learned from. Very long texts are packed
    span by span, in time linear in their length. Repeated rows and null ids are judged like
    any other; other columns are not read; an empty table gives an empty result.
    """
    learned = _learned(docs.sparkSession, docs)

    def batch(rows: pa.RecordBatch, coder: Coder):
        judged = coder.judge(rows.column("text").to_pylist(), margin)
        yield {
            "doc_id": rows.column("doc_id"),
            "held_out": rows.column("held_out"),
            "lang_pred": [one[0] for one in judged],
            "score": [one[1] for one in judged],
            "margin": [one[2] for one in judged],
            "rejected": [one[3] for one in judged],
        }

    return map_batches(
        docs.select("doc_id", "text", held_out().alias("held_out")),
        batch,
        "doc_id long, held_out boolean, lang_pred string, score double, margin double,"
        " rejected boolean",
        lambda: Coder(*learned.value),
    )


def accepted(docs: DataFrame, margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is not rejected."""
    learned = _learned(docs.sparkSession, docs)

    def run(batches):
        coder = Coder(*learned.value)
        for rows in batches:
            keep = [not one[3] for one in coder.judge(rows.column("text").to_pylist(), margin)]
            yield rows.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
