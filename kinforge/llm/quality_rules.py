"""Quality rules: counts over whole texts, then bands on how well public vocabularies fit them.

A text is read as words ``[^\\x20\\x09-\\x0D]+``. The base rule rejects texts of under 50 words or with over
half of their words in repeated 3-word windows. Every text is tokenised word by word with two public vocabularies
(neither merges over white space, so words can be encoded once and remembered): SentencePiece pieces with byte
fallback, and byte-level BPE for many languages. Measured are the code points per token of both, the share of
byte-fallback pieces, and the entropy in bits of ``WINDOW`` pieces, as the mean over windows that cover the text (so
that it does not grow with the text; the last window ends where the text does). Two kinds of band reject:

* per script (that of most letters), fixed outer bands for each measure (``BANDS``);
* per language, bands around what its texts need: for each measure the median over the distinct texts of the corpus
  that pass the base rule (copies count once, by text hash), and the typical distance from it, the error. What is
  measured spreads by the root of a text's tokens or windows, so distances are taken times that root. Errors
  have a floor (``FLOORS``), so that a group of near copies does not close the band. A text is out of the band if it is
  over ``MOST_ERRORS`` errors, and for code points also ``LEAST_SHIFT`` of the median, away. With n texts behind it a
  band is wider by the root of 1 + ``PRIOR_TEXTS`` / n: a language of few texts is judged by its script's band, and by
  its own the more texts it has, without a step. All statistics are read off exact histograms. A null language is the
  script's.

Repeated words are found by 64-bit hashes of the words; equal words always have equal hashes.

Defined results: null and empty texts have no words, zero counts and fail the base rule; measures of a text
without tokens are 0; whole texts are read, however long; rows that repeat are judged alike, null ids too; an empty
table gives an empty result; other columns are carried as they are.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from .arrow_text import TokenMemory, lists_to_flat, map_texts, mix, small_batches, span_hashes, spread, text_buffers, whole_row, word_bounds
from .staging import stage

VOCABULARY, MULTI_VOCABULARY = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: script: (least and most code points per piece and per token, most byte-fallback share, least entropy of a window)
BANDS = {
    "latin": (1.3, 8.0, 0.05, 3.0),
    "cyrillic": (1.2, 8.0, 0.05, 3.0),
    "greek": (0.6, 6.0, 0.5, 3.0),
    "arabic": (0.6, 6.0, 0.5, 3.0),
    "cjk": (0.3, 4.0, 0.9, 3.0),
    "other": (0.25, 8.0, 1.0, 2.5),
}
#: Last code point of each run of one script, in order; the letters of ASCII are counted apart.
_RUNS = ((0xBF, "other"), (0x24F, "latin"), (0x36F, "other"), (0x3FF, "greek"), (0x52F, "cyrillic"), (0x5FF, "other"), (0x6FF, "arabic"), (0x74F, "other"), (0x77F, "arabic"), (0x1DFF, "other"), (0x1EFF, "latin"), (0x303F, "other"), (0x30FF, "cjk"), (0x33FF, "other"), (0x9FFF, "cjk"), (0xABFF, "other"), (0xD7AF, "cjk"), (0x10FFFF, "other"))
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, script string, n_tokens long, n_tokens_multi long, chars_per_token double, chars_per_token_multi double, byte_share double, token_entropy double, fits boolean"
WINDOW = 50
MOST_ERRORS, LEAST_SHIFT, PRIOR_TEXTS = 6.0, 0.05, 100
#: Least error of each measure, of a text of one token or window: about the spread of token lengths, of a share at its
#: widest, and of a window's entropy.
FLOORS = {"chars_per_token": 0.9, "chars_per_token_multi": 0.9, "byte_share": 0.5, "token_entropy": 0.15}
#: Bins a unit of the histograms of measures and of their distances.
BINS = 1000
#: Words remembered by a task at most.
REMEMBERED = 200_000
#: Bytes of text that are measured at once.
CHUNK_BYTES = 1 << 18


class Fertility:
    """Tokens of words by a SentencePiece vocabulary, and their number by a byte-level one."""

    def __init__(self, path: str, multi_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(multi_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.multi = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.memory = TokenMemory(self._encode, REMEMBERED)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of each word, then its number of tokens by the other vocabulary, raised by the first one's size."""
        texts = [w.decode() for w in words]
        pieces = self.model.encode(texts, num_threads=1)
        for t, ids in zip(texts, pieces, strict=True):
            ids.append(self.size + len(self.multi.encode_ordinary(" " + t)))
        return lists_to_flat(pieces)

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of all texts' words, one after another; each word's number of pieces; and of tokens."""
        codes = np.concatenate([np.zeros(0, np.int64), *self.memory.codes([t.split() for t in texts])])
        ids = self.memory.ids_of(codes)
        marked = ids >= self.size
        return ids[~marked], self.memory.lengths[codes] - 1, ids[marked] - self.size


@lru_cache(maxsize=2)
def _fertility(path: str, multi_path: str) -> Fertility:
    return Fertility(path, multi_path)


def repeat_words(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """For each text, its words that lie in a 3-word window found twice or more in the text."""
    if len(hashes) < 3:
        return np.zeros(n, dtype=np.int64)
    window = mix(hashes[:-2]) + np.uint64(3) * mix(hashes[1:-1] ^ np.uint64(0x51)) + np.uint64(7) * mix(hashes[2:] ^ np.uint64(0xA3))
    at = np.flatnonzero(doc[:-2] == doc[2:])
    key = mix(window[at] ^ mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = np.zeros(len(at), dtype=bool)
    if len(at) > 1:
        equal = ordered[1:] == ordered[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    covered = np.zeros(len(hashes), dtype=bool)
    first = at[order[same]]
    for k in range(3):
        covered[first + k] = True
    return np.bincount(doc[covered], minlength=n)


def dup_lines(raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text, its lines that hold a word and equal an earlier line. starts: where words start."""
    n = len(offsets) - 1
    ends = np.flatnonzero(raw == 10)
    doc = np.searchsorted(offsets, ends, side="right") - 1
    begins = np.concatenate([offsets[:-1], ends + 1])
    stops_doc = np.concatenate([np.arange(n), doc])
    order = np.lexsort((begins, stops_doc))
    begins, line_doc = begins[order], stops_doc[order]
    stops = np.empty_like(begins)
    stops[:-1] = begins[1:] - 1
    last = np.append(line_doc[1:] != line_doc[:-1], True)
    stops[last] = offsets[line_doc[last] + 1]
    worded = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    begins, stops, line_doc = begins[worded], stops[worded], line_doc[worded]
    if not len(begins):
        return np.zeros(n, dtype=np.int64)
    key = mix(span_hashes(raw, begins, stops) ^ mix(line_doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    later = order[1:][key[order][1:] == key[order][:-1]]
    return np.bincount(line_doc[later], minlength=n)


def _scripts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The script of most letters of each text, by number in BANDS."""
    n, names = len(offsets) - 1, list(BANDS)
    counts = np.zeros((n, len(names)), dtype=np.int64)
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122) & (raw < 128)
    sums = np.concatenate([[0], np.cumsum(letter)])
    counts[:, 0] = sums[offsets[1:]] - sums[offsets[:-1]]
    lead = np.flatnonzero(raw >= 0xC2)
    if len(lead):
        b = raw.astype(np.int32)
        after = lambda k: b[np.minimum(lead + k, len(b) - 1)] & 63
        first = b[lead]
        code = np.where(first < 0xE0, (first & 31) << 6 | after(1), np.where(first < 0xF0, (first & 15) << 12 | after(1) << 6 | after(2), (first & 7) << 18 | after(1) << 12 | after(2) << 6 | after(3)))
        kind = np.array([names.index(s) for _, s in _RUNS])[np.searchsorted([c for c, _ in _RUNS], code)]
        doc = np.searchsorted(offsets, lead, side="right") - 1
        np.add.at(counts, (doc, kind), 1)
    best = counts.argmax(axis=1)
    best[counts.sum(axis=1) == 0] = names.index("other")
    return best


def measure(texts: pa.Array, path: str, multi_path: str) -> pa.StructArray:
    """The columns of MEASURES for each text."""
    raw, offsets = text_buffers(texts)
    n = len(offsets) - 1
    starts, ends, doc = word_bounds(raw, offsets)
    n_words = np.bincount(doc, minlength=n)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    word_chars = np.bincount(doc, weights=points[ends] - points[starts], minlength=n).astype(np.int64)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(b"#*$%&|<>")] = True
    symbols = np.concatenate([[0], np.cumsum(symbol[raw])])
    repeated = repeat_words(span_hashes(raw, starts, ends), doc, n)
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)

    data, cut = raw.tobytes(), offsets.tolist()
    fertility = _fertility(path, multi_path)
    ids, lengths, multi = fertility.tokens([data[a:b] for a, b in zip(cut, cut[1:], strict=False)])
    token_doc = np.repeat(doc, lengths)
    n_tokens = np.bincount(token_doc, minlength=n)
    n_multi = np.bincount(doc, weights=multi, minlength=n).astype(np.int64)
    some = np.maximum(n_tokens, 1)
    byte_share = np.bincount(token_doc, weights=fertility.is_byte[ids], minlength=n) / some
    windows = -(-n_tokens // WINDOW)
    window_doc = np.repeat(np.arange(n), windows)
    size = np.minimum(n_tokens, WINDOW)[window_doc]
    begins = (np.cumsum(n_tokens) - n_tokens)[window_doc] + np.minimum(spread(np.zeros(n, np.int64), windows) * WINDOW, n_tokens[window_doc] - size)
    inside = ids[spread(begins, size)].astype(np.int64)
    pairs, counts = np.unique(np.repeat(np.arange(len(size)), size) << 20 | inside, return_counts=True)
    of = pairs >> 20
    share = counts / size[of]
    entropy = np.bincount(window_doc[of], weights=-share * np.log2(share), minlength=n) / np.maximum(windows, 1)
    per_token, per_multi = word_chars / some, word_chars / np.maximum(n_multi, 1)

    script = _scripts(raw, offsets)
    least, most, bytes_most, entropy_least = np.array(list(BANDS.values()))[script].T
    fits = (np.minimum(per_token, per_multi) >= least) & (np.maximum(per_token, per_multi) <= most) & (byte_share <= bytes_most) & (entropy >= entropy_least)
    columns = [n_words, word_chars, symbols[offsets[1:]] - symbols[offsets[:-1]], dup_lines(raw, offsets, starts), repeated, failed, np.array(list(BANDS), dtype=object)[script], n_tokens, n_multi, per_token, per_multi, byte_share, entropy, fits]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
    fields = [x.split() for x in MEASURES.split(", ")]
    return pa.StructArray.from_arrays([pa.array(c, type=kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


def _median(values: DataFrame, value: Column) -> DataFrame:
    """The median of value for each measure and key, to a bin's width, and the number of rows: measure, key, median, n."""
    counted = values.groupBy("measure", "key", F.floor(value * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    window = Window.partitionBy("measure", "key")
    running = counted.withColumn("below", F.sum("c").over(window.orderBy("bin"))).withColumn("n", F.sum("c").over(window))
    return running.where(F.col("below") * 2 >= F.col("n")).groupBy("measure", "key").agg(((F.min("bin") + 0.5) / BINS).alias("median"), F.first("n").alias("n"))


def _samples() -> Column:
    """What a measured row tells each band: (measure, key, x, weight). Its distance from a median counts weight times."""
    rules = lambda c: F.col(f"rules.{c}")
    one = lambda name, weight: F.struct(F.lit(name).alias("measure"), F.col("key"), rules(name).alias("x"), F.sqrt(weight).alias("weight"))
    n = rules("n_tokens")
    return F.array(one("chars_per_token", n), one("chars_per_token_multi", rules("n_tokens_multi")), one("byte_share", n), one("token_entropy", F.ceil(n / WINDOW)))


def _language_bands(measured: DataFrame) -> DataFrame:
    """measure, key, median, n and error of each band."""
    numbers = ["n_tokens", "n_tokens_multi", *FLOORS]
    texts = measured.where("not rules.base_failed").select("hash", "key", *[f"rules.{c}" for c in numbers])
    texts = texts.groupBy("key", "hash").agg(*[F.first(c).alias(c) for c in numbers]).withColumn("rules", F.struct(*numbers))
    texts = stage(texts.select(F.inline(_samples())), "fertility-texts")
    medians = stage(_median(texts, F.col("x")), "fertility-medians")
    apart = texts.join(medians, ["measure", "key"]).select("measure", "key", (F.abs(F.col("x") - F.col("median")) * F.col("weight")).alias("distance"))
    floor = F.coalesce(*[F.when(F.col("measure") == m, F.lit(v)) for m, v in FLOORS.items()])
    errors = _median(apart, F.col("distance")).select("measure", "key", F.greatest(F.col("median") * 1.4826, floor).alias("error"))
    return medians.join(errors, ["measure", "key"])


def judge(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, vocabulary: str | None = None, lang_col: str | None = "lang", multi_vocabulary: str | None = None) -> DataFrame:
    """A row for each row: ``row`` (a struct of the carried columns, all by default), ``rules`` (MEASURES; fits:
    within the script's bands), ``errors`` (a struct: each measure's distance from the language's median in errors,
    null where the language has no text that passes the base rule) and ``kept``."""
    if vocabulary is None or multi_vocabulary is None:
        import public_tokenizers

        vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
        multi_vocabulary = multi_vocabulary or public_tokenizers.path(MULTI_VOCABULARY)
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select((whole_row(docs.select(*[F.col(f"`{c}`") for c in carry])) if carry else whole_row(docs)).alias("row"), lang.alias("lang"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"))

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("lang"), batch.column("hash"), measure(batch.column("text"), vocabulary, multi_vocabulary)], names=["row", "lang", "hash", "rules"])

    schema = StructType([rows.schema["row"], rows.schema["lang"], rows.schema["hash"], StructField("rules", StructType.fromDDL(MEASURES))])
    with small_batches(docs.sparkSession):
        measured = stage(map_texts(rows, kernel, schema, "text", CHUNK_BYTES, done=lambda: _fertility(vocabulary, multi_vocabulary).memory.reset()).withColumn("key", F.coalesce("lang", "rules.script")), "measured")
    bands = stage(_language_bands(measured), "fertility-bands")
    judged = measured.withColumn("samples", _samples())
    errors, out = [], F.lit(False)
    for i, name in enumerate(FLOORS):
        own = bands.where(F.col("measure") == name).select(F.col("key").alias(f"key_{i}"), F.col("median").alias("median"), (F.col("error") * F.sqrt(1 + PRIOR_TEXTS / F.col("n"))).alias("error"))
        judged = judged.join(own.select(f"key_{i}", F.struct("median", "error").alias(f"band_{i}")), F.col("samples")[i]["key"] == F.col(f"key_{i}"), "left")
        band, sample = F.col(f"band_{i}"), F.col("samples")[i]
        away = (sample["x"] - band["median"]) * sample["weight"] / band["error"]
        errors.append(away.alias(name))
        far = F.abs(sample["x"] - band["median"]) > (F.lit(0.0) if name in ("byte_share", "token_entropy") else band["median"] * LEAST_SHIFT)
        wrong = away > MOST_ERRORS if name == "byte_share" else F.abs(away) > MOST_ERRORS
        out = out | F.coalesce(wrong & far, F.lit(False))
    return judged.select("row", "rules", F.struct(*errors).alias("errors"), (~F.col("rules.base_failed") & F.col("rules.fits") & ~out).alias("kept"))


def keep(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, lang_col: str | None = "lang", multi_vocabulary: str | None = None) -> DataFrame:
    """The rows of docs that no rule rejects, with all their columns."""
    return judge(docs, text_col, None, vocabulary, lang_col, multi_vocabulary).where("kept").select("row.*")
