"""Language identification by compression.

Each learned language has a raw-content dictionary of zstandard: labelled texts, one after the other, up
to ``dict_bytes``. A text is coded with every dictionary, in chunks of ``chunk`` bytes, and the language
whose dictionary codes it smallest is chosen; its score is the part that it saves against the second.
Texts are lower-cased and everything but letters becomes a single space, so that numbers, symbols and
capitals don't decide.

Fitting reads a bounded sample: of each language the ``sample_docs`` labelled documents whose hashed ids
are least, and of each of those a piece of at most ``sample_bytes``, which begins anywhere in the text, by a hash (of a repeated id the least piece). The sample is cleaned: dictionaries of one half
code the other, and texts that another language codes smaller are left out of the final dictionaries.
Languages are as many as there are labels, each with one dictionary on every task.

Defined results: text that is null, empty or without a letter is "und" with score 0; with one learned
language every other text gets it with score 1; with none, "und" with score 0; ties go to the language
first by code point and are narrow; texts of any length are coded whole; repeated rows are each scored;
an empty table gives no rows; other columns pass through, but for those with a result's name, which gives way to it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import hidden, rows_of, shown, small_batches

#: ASCII that isn't a letter becomes a space; the bytes of other characters stay.
_ASCII = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_ASCII).split())


@dataclass(frozen=True)
class Settings:
    """floor, margin: a lead below so many bytes and this part of the second size is narrow (README says how they were set); short: texts of up to so many bytes are coded after
    ``lead`` bytes of the dictionary itself, less what those take alone: by themselves zstandard would store them as they are; piece: sample texts are cleaned by pieces, of
    which those go that another language codes in less by the factor ``doubt``."""

    sample_docs: int = 512
    sample_bytes: int = 4096
    dict_bytes: int = 112 << 10
    piece: int = 512
    chunk: int = 4096
    short: int = 128
    lead: int = 1024
    level: int = 6
    margin: float = 0.06
    floor: float = 2.0
    doubt: float = 1.02


class Model:
    def __init__(self, dictionaries: dict[str, bytes], settings: Settings):
        self.dictionaries, self.languages, self.settings = dictionaries, sorted(dictionaries), settings
        self._coders = [self._coder(dictionaries[name], settings.level) for name in self.languages]
        self._leads = [dictionaries[name][: settings.lead] + b" " for name in self.languages]

        self._alone = [len(c.compress(lead)) for c, lead in zip(self._coders, self._leads, strict=True)]

    @staticmethod
    def _coder(content: bytes, level: int) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, text: bytes) -> list[int]:
        s = self.settings
        if len(text) <= s.short:
            return [max(0, len(c.compress(lead + text)) - alone) for c, lead, alone in zip(self._coders, self._leads, self._alone, strict=True)]
        parts = [text[i : i + s.chunk] for i in range(0, len(text), s.chunk)]
        return [sum(len(c.compress(p)) for p in parts) for c in self._coders]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, whether the margin is too narrow or there is nothing to go by)."""
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        sizes = self.sizes(plain(text))
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        second = min(n for i, n in enumerate(sizes) if i != best)
        score = 1 - sizes[best] / second if second else 0.0
        return self.languages[best], score, second - sizes[best] < self.settings.floor + self.settings.margin * second


def _dictionary(pieces: list[bytes], most: int) -> bytes:
    """The first pieces, up to ``most`` bytes."""
    return b" ".join(pieces)[:most]


def train(rows: list[tuple[str, str]], settings: Settings) -> Model:
    """rows: (language, text). Two rounds of cleaning: each half's pieces that the other half's dictionaries give to another language go."""
    by: dict[str, list[bytes]] = {}
    for name, text in rows:
        if text and _LETTER.search(text):
            t = plain(text)[: settings.sample_bytes]
            by.setdefault(name, []).extend(t[i : i + settings.piece] for i in range(0, len(t), settings.piece))
    held = {name: list(dict.fromkeys(p for p in ps if p)) for name, ps in by.items()}
    kept = held
    for _ in range(2 if len(held) > 1 else 0):
        halves = [Model({n: d for n, ps in kept.items() if (d := _dictionary(ps[k::2], settings.dict_bytes))}, settings) for k in (0, 1)]
        inside = [{n: set(ps[k::2]) for n, ps in kept.items()} for k in (0, 1)]
        new = {}
        for name, pieces in held.items():
            good = []
            for i, p in enumerate(pieces):
                judge = halves[1] if p in inside[0][name] else halves[0] if p in inside[1][name] else halves[i % 2]
                sizes = judge.sizes(p)
                if name in judge.languages and sizes[judge.languages.index(name)] <= settings.doubt * min(sizes):
                    good.append(p)
            new[name] = good or pieces
        kept = new
    return Model({n: d for n, ps in kept.items() if (d := _dictionary(ps, settings.dict_bytes))}, settings)


def fit(docs: DataFrame, learn: Column, settings: Settings = Settings()) -> Model:
    """A model of the rows where ``learn`` holds, by their columns text and lang; doc_id only picks the sample."""
    spark, hashed = docs.sparkSession, F.xxhash64(F.lit("langid"), "doc_id")
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    # Hashes below a bound are some four times as many as are wanted: only these meet by language.
    per = labelled.groupBy("lang").count().collect()
    bounds = rows_of(spark, [(r["lang"], float(min(1.0, 4 * (settings.sample_docs + 16) / r["count"]))) for r in per], "l string, part double")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    some = labelled.join(F.broadcast(bounds), F.col("lang") == F.col("l")).withColumn("h", hashed).where(F.col("h") / F.lit(2.0**64) + 0.5 <= F.col("part"))
    ids = some.select("doc_id", "lang", "h").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.sample_docs).select("doc_id", "lang", "place")
    room = F.greatest(F.lit(1), F.length("text") - settings.sample_bytes + 1)
    begin = F.pmod(F.xxhash64(F.lit("piece"), "doc_id"), room.cast("long")).cast("int") + 1
    texts = docs.where(learn & F.col("text").isNotNull()).select(F.col("doc_id").alias("d"), F.col("lang").alias("l"), F.substring("text", begin, F.lit(settings.sample_bytes)).alias("text"))
    # At most languages x sample_docs rows are picked, so the picked ids are sent to the texts; of a repeated id one text stays.
    got = texts.join(F.broadcast(ids), (F.col("d") == F.col("doc_id")) & (F.col("l") == F.col("lang"))).groupBy("lang", "place").agg(F.min("text").alias("text")).toPandas()
    got = got.sort_values(["lang", "place", "text"])
    return train(list(zip(got["lang"], got["text"], strict=True)), settings)


def identify(docs: DataFrame, learn: Column | None = None, settings: Settings = Settings(), model: Model | None = None, carry: list[str] | None = None) -> DataFrame:
    """The carried columns, lang_pred, lang_score and lang_rejected of every row."""
    small_batches(docs.sparkSession)
    model = model or fit(docs, F.lit(True) if learn is None else learn, settings)
    names, made = {}, docs.sparkSession.sparkContext.broadcast(_packed(model))
    cols, pairs = hidden(docs, carry if carry is not None else docs.columns)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        if "model" not in names:
            names["model"] = Model(*made.value)
        return pd.DataFrame([names["model"](t) for t in texts], columns=["lang", "score", "rejected"])

    out = docs.select(*cols, judge(docs["text"].cast("string")).alias("__j"))
    return out.select(*shown(pairs, "lang_pred", "lang_score", "lang_rejected"), F.col("__j.lang").alias("lang_pred"), F.col("__j.score").alias("lang_score"), F.col("__j.rejected").alias("lang_rejected"))


def _packed(model: Model) -> tuple:
    return model.dictionaries, model.settings
