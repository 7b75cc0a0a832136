"""Fill-in-the-middle transformation: texts cut at two boundaries, which a wavelet matrix over character classes finds.

Every code point has a class: inside of a piece, end of a word, line break, or
end of the text. A level of cutting (words, lines, characters) is a set of
classes, and the number of boundaries before a place is the sum of their ranks
there: of the whole text for the number of units, and by bisection on these sums
for the place where a given number of units ends. The classes of a slice of many
texts share one matrix, and all their cuts are bisected together.

A unit of words is a word with the separators before it; separators at the end
of a text are one of their own. The draws (which cuts, whether, which order) come
from the sha256 of seed and id, so reruns and retried tasks agree. The rest is
made of DataFrame functions: prefix, suffix and middle, each behind its mark.

Defined results: null and empty texts are plain, without units; a text that holds
a mark is plain, so that marks can be found again; a null id draws as the text
``null``; repeated rows are drawn alike; columns beside doc_id and text take no
part; texts are cut whole, whatever their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import separators, slices, table
from vigil.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
SEED, RATE, SUFFIX_FIRST = "42", 50, 80
INSIDE, WORD_END, LINE_BREAK, TEXT_END = range(4)
#: The classes after which each level may cut.
LEVELS = {"word": (WORD_END, TEXT_END), "line": (LINE_BREAK, TEXT_END), "character": (INSIDE, WORD_END, LINE_BREAK, TEXT_END)}


def character_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes, bounds): the class of each code point of the texts in data, and where each text's begin."""
    lead = (data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    bounds = np.append(before[starts], before[-1])
    points = data[lead]
    blank = separators()[points]
    last = bounds[1:][ends > starts] - 1
    classes = np.full(len(points), INSIDE, dtype=np.int8)
    classes[:-1][~blank[:-1] & blank[1:]] = WORD_END
    classes[points == 0x0A] = LINE_BREAK
    classes[last] = TEXT_END
    return classes, bounds


def boundaries(matrix: WaveletMatrix, level: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many units end in each range."""
    return sum(matrix.count(c, start, end) for c in LEVELS[level])


def place(matrix: WaveletMatrix, level: str, start: np.ndarray, end: np.ndarray, units: np.ndarray) -> np.ndarray:
    """After how many code points from start so many units have ended: the least place with that rank, by bisection."""
    low, high = start.copy(), end.copy()
    while (low < high).any():
        half = (low + high) >> 1
        enough = boundaries(matrix, level, start, half) >= units
        low, high = np.where(enough | (low >= high), low, half + 1), np.where(enough & (low < high), half, high)
    return low - start


def cut_places(level: str):
    """A column function of (text, first draw, second draw): struct of units, and code points before either cut."""

    @F.arrow_udf("units long, first long, second long")
    def cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        draws = np.stack([one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)]).astype(np.int64)
        out = np.zeros((3, len(text)), dtype=np.int64)
        for part in slices(text):
            classes, bounds = character_classes(part.data, part.starts, part.ends)
            matrix = WaveletMatrix(classes, 2)
            start, end = bounds[:-1], bounds[1:]
            units = boundaries(matrix, level, start, end)
            wanted = draws[:, part.first : part.last] % (units + 1)
            out[:, part.first : part.last] = units, *(place(matrix, level, start, end, k) for k in (wanted.min(axis=0), wanted.max(axis=0)))
        return pa.StructArray.from_arrays([pa.array(x) for x in out], names=["units", "first", "second"])

    return cuts


def draw(doc_id: Column, seed: str, k: int) -> Column:
    """The k-th group of eight hexadecimal digits of the sha256 of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, level: str = "word", seed: str = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, text, units, form, prefix_chars, middle_chars, output): rate per cent of the texts are cut, suffix_first per cent of these as spm."""
    text, cut = F.coalesce("text", F.lit("")), F.col("cut")
    marked = F.greatest(*(F.contains(text, F.lit(m)) for m in MARKS))
    plain = (text == "") | marked | (draw(F.col("doc_id"), seed, 3) % 100 >= rate)
    form = F.when(plain, "plain").when(draw(F.col("doc_id"), seed, 4) % 100 < suffix_first, "spm").otherwise("psm")
    found = docs.select("doc_id", text.alias("text"), form.alias("form"), cut_places(level)(text, draw(F.col("doc_id"), seed, 1), draw(F.col("doc_id"), seed, 2)).alias("cut"))
    text, length = F.col("text"), cut["second"] - cut["first"]
    prefix, middle, suffix = F.substring(text, F.lit(1), cut["first"]), F.substring(text, cut["first"] + 1, length), F.substring(text, cut["second"] + 1, F.length(text))
    p, s, m = map(F.lit, MARKS)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text)
    of_cut = F.col("form") != "plain"
    return found.select("doc_id", "text", cut["units"].alias("units"), "form", F.when(of_cut, cut["first"]).alias("prefix_chars"), F.when(of_cut, length).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that fill_in_middle cut. No mark begins with another's end, so the first of each kind is the one put there."""
    p, s, m = map(F.lit, MARKS)
    head, middle = F.split_part(output, m, F.lit(1)), F.split_part(output, m, F.lit(2))
    psm = F.concat(F.split_part(F.split_part(head, s, F.lit(1)), p, F.lit(2)), middle, F.split_part(head, s, F.lit(2)))
    spm = F.concat(F.split_part(head, p, F.lit(2)), middle, F.split_part(F.split_part(head, p, F.lit(1)), s, F.lit(2)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2(x, 256).alias(f"{name}_sha256") for name, x in (("output", F.col("output")), ("restored", restored(F.col("output"), F.col("form"))))]
    return done.select("doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars", *digests)


OP13_SQL = r"""
    WITH drawn AS (
      SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, 'null')) AS digest,
             regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
      FROM documents),
    numbers AS (
      SELECT *, len(units)::BIGINT AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
             ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4
      FROM drawn),
    cut AS (
      SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
        array_to_string(units[1 + least(h1 % (n + 1), h2 % (n + 1)):greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
        array_to_string(units[1 + greatest(h1 % (n + 1), h2 % (n + 1)):], '') AS suffix
      FROM numbers)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM cut"""
