"""Text functions as Column expressions: white space, headers, citations, references, cards, tokens."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the results depend on, character by character.
POINT_LETTERS = "a-zăâđêôơưăằẳẵặắấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"
REFERENCE_LETTERS = "a-zăâđêôơưà-ỹ"
WORD_LETTERS = "a-zA-ZăâđêôơưĂÂĐÊÔƠƯ"
FULL_WIDTH_DIGITS = "０１２３４５６７８９"
INSTRUMENTS = ("Thông tư", "Nghị định", "Quyết định", "Luật", "Pháp lệnh", "Nghị quyết", "Chỉ thị", "Thông báo", "Tờ trình")
ACTORS = ("hộ kinh doanh", "cá nhân kinh doanh", "cá nhân", "doanh nghiệp", "tổ chức")
DEFAULT_ACTOR = "người nộp thuế"
TOPICS = ("hóa đơn", "thuế suất", "khai thuế", "nộp thuế", "miễn thuế", "giảm thuế", "chứng từ", "sổ sách", "quản lý thuế", "xử phạt", "phạt")
TOPIC_NAMES = {"phạt": "xử phạt"}
FACT_PREFIX = "Áp dụng theo "
GLOSS_CHARS = 280

#: White space in the widest sense, as a class for patterns.
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
#: The characters of WS, for functions that take them one by one.
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
DIGITS = r"\p{Nd}+"

DIEU = rf"^[ \t]*Điều[ \t]+({DIGITS})[ \t]*[.:\-)]"
KHOAN = rf"^[ \t]*Khoản[ \t]+({DIGITS})[ \t]*[.:\-)]"
DIEM = rf"^[ \t]+(?:Điểm[ \t]+)?([{POINT_LETTERS}])[ \t]*[).]"
CHAPTER = rf"(?md)^{WS}*Chương{WS}+[IVXLCDM]+\b"
HEADER_LEAD = rf"^{WS}*Điều{WS}+{DIGITS}{WS}*[.:]?{WS}*"
PENALTY = rf"(?iu)phạt{WS}+[^.\n]{{4,200}}"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(text, F.lit(WS_CHARS))


def folded_digits(text: Column) -> Column:
    """Full-width digits as ASCII ones, each of them."""
    return F.translate(text, FULL_WIDTH_DIGITS, "0123456789")


def has_content(text: Column) -> Column:
    """Anything but spaces, tabs and line ends."""
    return F.ltrim(text, F.lit(" \t\r\n")) != ""


def header_kind(line: Column) -> Column:
    """dieu, khoan or diem for a header line, the most general first; else null. How a line begins says which pattern may match at all."""
    led = F.ltrim(line, F.lit(" \t"))
    of = lambda begins, p: begins & F.rlike(line, F.lit(p))
    return (
        F.when(of(led.startswith("Điều"), DIEU), "dieu").when(of(led.startswith("Khoản"), KHOAN), "khoan").when(of(line.startswith(" ") | line.startswith("\t"), DIEM), "diem")
    )


def _by_kind(kind: Column, make) -> Column:
    return F.when(kind == "dieu", make(DIEU)).when(kind == "khoan", make(KHOAN)).when(kind == "diem", make(DIEM))


def header_number(line: Column, kind: Column) -> Column:
    return folded_digits(_by_kind(kind, lambda p: F.regexp_extract(line, p, 1)))


def after_header(line: Column, kind: Column) -> Column:
    """The rest of a header line; other lines as they are."""
    return F.coalesce(_by_kind(kind, lambda p: F.substr(line, F.length(F.regexp_extract(line, p, 0)) + 1)), line)


def citation(kind: Column, number: Column, dieu: Column, khoan: Column) -> Column:
    """The canonical name; an ancestor article that doesn't exist is called None."""
    of = F.concat(F.lit(" Điều "), F.coalesce(dieu, F.lit("None")))
    return (
        F.when(kind == "dieu", F.concat(F.lit("Điều "), number))
        .when(kind == "khoan", F.concat(F.lit("Khoản "), number, of))
        .otherwise(F.concat(F.lit("Điểm "), number, F.coalesce(F.concat(F.lit(" Khoản "), khoan), F.lit("")), of))
    )


def parent_citation(kind: Column, dieu: Column, khoan: Column) -> Column:
    """The name of the clause above; null at the top or without an article."""
    article = F.concat(F.lit("Điều "), dieu)
    return F.when(kind == "khoan", article).when(kind == "diem", F.when(khoan.isNotNull(), F.concat(F.lit("Khoản "), khoan, F.lit(" "), article)).otherwise(article))


# ---- references


@dataclass(frozen=True)
class ReferencePattern:
    """target: parts of the target citation, literal or the number of a group; holds: what a text with a match holds."""

    rank: int
    kind: str
    pattern: str
    target: tuple[str | int, ...]
    holds: tuple[str, ...]


# A class before the rest of a word is tried at each place faster than two whole words.
_DIEU, _KHOAN, _DIEM = "[Đđ]iều", "[Kk]hoản", "[Đđ]iểm"
_THIS = "[Đđ]iều này"


def reference_patterns(strict_digits: bool = False) -> tuple[ReferencePattern, ...]:
    """Seven patterns, in the order that decides ties.

    A number before ``. : - )`` loses its last digit, and a single digit there gives nothing, as the look-ahead
    makes the number shorter; with strict_digits the number is taken whole or not at all.
    """
    last = rf"({DIGITS}{'+' if strict_digits else ''})(?!{WS}*[.:\-)])"
    letter, number = f"([{REFERENCE_LETTERS}])", f"({DIGITS})"
    seq = lambda *parts: f"{WS}+".join(parts)
    return (
        ReferencePattern(0, "internal", seq(_DIEM, letter, _KHOAN, number, _DIEU, last), ("Điểm ", 1, " Khoản ", 2, " Điều ", 3), ("iểm", "hoản", "iều")),
        ReferencePattern(1, "internal_self", seq(_DIEM, letter, _KHOAN, number, _THIS), ("Điểm ", 1, " Khoản ", 2, " Điều này"), ("iểm", "hoản", "iều này")),
        ReferencePattern(2, "internal", seq(_KHOAN, number, _DIEU, last), ("Khoản ", 1, " Điều ", 2), ("hoản", "iều")),
        ReferencePattern(3, "internal_self", seq(_KHOAN, number, _THIS), ("Khoản ", 1, " Điều này"), ("hoản", "iều này")),
        ReferencePattern(4, "internal", seq(_DIEM, letter, _DIEU, last), ("Điểm ", 1, " Điều ", 2), ("iểm", "iều")),
        ReferencePattern(5, "internal", rf"[Đđ](?<![{WORD_LETTERS}][Đđ]){seq('iều', number)}", ("Điều ", 1), ("iều",)),
        ReferencePattern(6, "external", seq(f"(?=[{''.join(sorted({i[0] for i in INSTRUMENTS}))}])({'|'.join(INSTRUMENTS)})", "số", r"([0-9０-９]+(?:[/-][0-9０-９A-Za-zĐƠƯ]+)*)"), (1, " số ", 2), ("số",)),
    )


def references(body: Column, strict_digits: bool = False) -> Column:
    """All different matches of all patterns: array of (rank, place, kind, raw_text, target_citation, position), not yet deduplicated."""

    def of(p: ReferencePattern) -> Column:
        def one(raw: Column, k: Column) -> Column:
            group = lambda g: F.regexp_extract(raw, p.pattern, g)
            parts = [F.lit(t) if isinstance(t, str) else folded_digits(group(t)) if p.kind == "external" and t == 2 else group(t) for t in p.target]
            return F.struct(
                F.lit(p.rank).alias("rank"), k.alias("place"), F.lit(p.kind).alias("kind"), raw.alias("raw_text"), F.concat(*parts).alias("target_citation"), F.instr(body, raw).alias("position")
            )

        may = reduce(lambda a, b: a & b, [F.contains(body, F.lit(h)) for h in p.holds])
        # What a text says again has the same target and position, and of these the first counts.
        return F.transform(F.array_distinct(F.regexp_extract_all(F.when(may, body).when(body.isNotNull(), ""), F.lit(p.pattern), F.lit(0))), one)

    return F.concat(*[of(p) for p in reference_patterns(strict_digits)])


def resolved_target(kind: Column, target: Column, ancestor: Column) -> Column:
    """A reference to "this article" by the article's number, where there is one."""
    return F.when((kind == "internal_self") & ancestor.isNotNull(), F.regexp_replace(target, "này$", ancestor)).otherwise(target)


# ---- cards


def without_header(body: Column) -> Column:
    return strip(F.regexp_replace(body, HEADER_LEAD, ""))


def gloss(body: Column) -> Column:
    """The first line up to its first sentence or part end, at most GLOSS_CHARS characters."""
    line = strip(F.substring_index(strip(body), "\n", 1))
    cut = F.lit(None).cast("string")
    for stop in ("; ", ". "):
        at = F.instr(line, stop) - 1
        cut = F.when((at > 0) & (at <= GLOSS_CHARS), F.substring(line, F.lit(1), at)).otherwise(cut)
    return strip(F.coalesce(cut, F.substring(line, 1, GLOSS_CHARS)))


def first_named(body: Column, names: tuple[str, ...], otherwise: str | None, said: dict[str, str] | None = None) -> Column:
    """The first of the names, in their order, that the text holds."""
    low, out = F.lower(body), F.lit(otherwise).cast("string")
    for name in reversed(names):
        out = F.when(F.contains(low, F.lit(name)), F.lit((said or {}).get(name, name))).otherwise(out)
    return out


def penalty(body: Column) -> Column:
    found = F.regexp_extract(body, PENALTY, 0)
    return F.when(found != "", strip(found))


def card_error(statement: Column, actor: Column, tags: Column, facts: Column, fine: Column, most: int = 600) -> Column:
    """The first rule that a card breaks; null for a valid card."""
    blank = lambda c: c.isNull() | (strip(c) == "")
    bad = lambda a: a.isNull() | F.exists(a, lambda x: x.isNull() | (strip(x) == ""))
    return (
        F.when(blank(statement), "statement is blank")
        .when(F.length(statement) > most, "statement is too long")
        .when(blank(actor), "bound_actor is blank")
        .when(bad(tags), "topic_tags holds a blank")
        .when(bad(facts), "required_facts holds a blank")
        .when(fine.isNotNull() & (strip(fine) == ""), "penalty is blank")
    )


# ---- tokens and files


def tokens(text: Column) -> Column:
    """Lower-cased maximal runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def page_image_path(out_dir: Column, document_id: Column, page: Column) -> Column:
    return F.format_string("%s/doc%d/page%04d.png", out_dir, document_id, page)


def artifact_path(out_dir: Column, document_id: Column, page: Column) -> Column:
    return F.format_string("%s/ocr/doc%d/page%04d.json", out_dir, document_id, page)


def image_data_url(path: Column, content: Column) -> Column:
    """A data URL; anything but .png is called JPEG."""
    mime = F.when(F.lower(path).endswith(".png"), "image/png").otherwise("image/jpeg")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))
