"""DuckDB SQL of the registered queries, as chains of named steps over the corpus view."""

from __future__ import annotations

from ..functions import text as X
from .corpus import LINES_SQL

WS = X.WS
STRIP = lambda s: f"regexp_replace(regexp_replace({s}, '^{WS}+', ''), '{WS}+$', '')"

PARSED_SQL = f"""
heads AS (
  SELECT *, CASE WHEN regexp_matches(line, '{X.DIEU}') THEN 'dieu' WHEN regexp_matches(line, '{X.KHOAN}') THEN 'khoan' WHEN regexp_matches(line, '{X.DIEM}') THEN 'diem' END AS kind FROM lines
), numbered AS (
  SELECT *, CASE kind WHEN 'dieu' THEN regexp_extract(line, '{X.DIEU}', 1) WHEN 'khoan' THEN regexp_extract(line, '{X.KHOAN}', 1) WHEN 'diem' THEN regexp_extract(line, '{X.DIEM}', 1) END AS number,
         CASE kind WHEN 'dieu' THEN regexp_replace(line, '{X.DIEU}', '') WHEN 'khoan' THEN regexp_replace(line, '{X.KHOAN}', '') WHEN 'diem' THEN regexp_replace(line, '{X.DIEM}', '') ELSE line END AS rest,
         sum(CASE WHEN kind IS NOT NULL THEN 1 ELSE 0 END) OVER w AS ord, sum(CASE WHEN kind = 'dieu' THEN 1 ELSE 0 END) OVER w AS article
  FROM heads WINDOW w AS (PARTITION BY document_id ORDER BY page, line_no ROWS UNBOUNDED PRECEDING)
), grouped AS (
  SELECT document_id, ord, max(article) FILTER (WHERE kind IS NOT NULL) AS article, max(kind) AS kind, max(number) AS number, max(page) FILTER (WHERE kind IS NOT NULL) AS page_start,
         max(page) FILTER (WHERE regexp_matches(rest, '[^ \\t\\r\\n]')) AS last, string_agg(rest, chr(10) ORDER BY page, line_no) AS text
  FROM numbered WHERE ord > 0 GROUP BY document_id, ord
), parents AS (
  SELECT *, last_value(CASE WHEN kind = 'dieu' THEN number END IGNORE NULLS) OVER a AS dieu, last_value(CASE WHEN kind = 'khoan' THEN number END IGNORE NULLS) OVER a AS khoan
  FROM grouped WINDOW a AS (PARTITION BY document_id, article ORDER BY ord ROWS UNBOUNDED PRECEDING)
), parsed AS (
  SELECT document_id, ord::INTEGER AS ord, kind, number, dieu, khoan, page_start, coalesce(greatest(last, page_start), page_start) AS page_end, {STRIP("text")} AS body,
         CASE kind WHEN 'dieu' THEN 'Điều ' || number WHEN 'khoan' THEN 'Khoản ' || number || ' Điều ' || coalesce(dieu, 'None')
           ELSE 'Điểm ' || number || coalesce(' Khoản ' || khoan, '') || ' Điều ' || coalesce(dieu, 'None') END AS citation,
         CASE kind WHEN 'khoan' THEN 'Điều ' || dieu WHEN 'diem' THEN CASE WHEN khoan IS NOT NULL THEN 'Khoản ' || khoan || ' Điều ' || dieu ELSE 'Điều ' || dieu END END AS above
  FROM parents
)"""

STORED_SQL = """
ranked AS (SELECT *, min(ord) OVER c AS first_ord, max(ord) OVER c AS last_ord FROM parsed WINDOW c AS (PARTITION BY document_id, citation)
), kept AS (SELECT *, document_id * 16777216 + first_ord AS clause_id FROM ranked WHERE ord = last_ord
), clauses AS (
  SELECT k.*, p.clause_id AS parent_id FROM kept k LEFT JOIN kept p ON p.document_id = k.document_id AND p.citation = k.above
)"""


def _references_sql() -> str:
    """Patterns without look-around: what follows a last number is captured, and decides how much of it stays."""
    tail = rf"({X.DIGITS})({WS}*[.:\-)])?"
    letter, number = f"([{X.REFERENCE_LETTERS}])", f"({X.DIGITS})"
    dieu, khoan, diem, this = "(?:Điều|điều)", "(?:Khoản|khoản)", "(?:Điểm|điểm)", "(?:Điều này|điều này)"
    seq = lambda *parts: f"{WS}+".join(parts)
    patterns = [
        (0, "internal", seq(diem, letter, khoan, number, dieu, tail), "'Điểm ' || g1 || ' Khoản ' || g2 || ' Điều ' || g3", 3),
        (1, "internal_self", seq(diem, letter, khoan, number, this), "'Điểm ' || g1 || ' Khoản ' || g2 || ' Điều này'", 0),
        (2, "internal", seq(khoan, number, dieu, tail), "'Khoản ' || g1 || ' Điều ' || g2", 2),
        (3, "internal_self", seq(khoan, number, this), "'Khoản ' || g1 || ' Điều này'", 0),
        (4, "internal", seq(diem, letter, dieu, tail), "'Điểm ' || g1 || ' Điều ' || g2", 2),
        (5, "internal", rf"(?:^|[^{X.WORD_LETTERS}]){seq(dieu, number)}", "'Điều ' || g1", -1),
        (6, "external", seq(f"({'|'.join(X.INSTRUMENTS)})", "số", r"([0-9０-９]+(?:[/-][0-9０-９A-Za-zĐƠƯ]+)*)"), "g1 || ' số ' || translate(g2, '０１２３４５６７８９', '0123456789')", 0),
    ]
    parts = []
    for rank, kind, pattern, target, last in patterns:
        groups = ", ".join(f"regexp_extract(m, '{pattern}', {g}) AS g{g}" for g in range(1, 5) if g <= pattern.count("(") - pattern.count("(?:"))
        found = f"SELECT document_id, ord, citation, dieu, body, unnest(f) AS m, unnest(range(0, len(f))) AS place FROM (SELECT *, regexp_extract_all(body, '{pattern}', 0) AS f FROM parsed)"
        if last > 0:
            # The last number, cut by a digit where a mark follows; a single digit there is no match.
            cut = f"CASE WHEN coalesce(g{last + 1}, '') = '' THEN g{last} ELSE left(g{last}, length(g{last}) - 1) END"
            raw = f"left(m, length(m) - length(coalesce(g{last + 1}, '')) - CASE WHEN coalesce(g{last + 1}, '') = '' THEN 0 ELSE 1 END)"
            where = f"WHERE coalesce(g{last + 1}, '') = '' OR length(g{last}) > 1"
            target = target.replace(f"g{last}", f"({cut})")
        elif last < 0:
            raw, where = "regexp_extract(m, '(?:Điều|điều).*$', 0, 's')", ""
        else:
            raw, where = "m", ""
        parts.append(f"SELECT document_id, ord, citation, dieu, body, {rank} AS rank, place, '{kind}' AS kind, {raw} AS raw_text, {target} AS target_citation FROM (SELECT *, {groups} FROM ({found})) {where}")
    union = "\n  UNION ALL ".join(parts)
    return f"""
matches AS (
  {union}
), extracted AS (
  SELECT *, row_number() OVER (PARTITION BY document_id, ord ORDER BY position, rank, place) AS no FROM (
    SELECT *, row_number() OVER (PARTITION BY document_id, ord, lower(raw_text), lower(target_citation) ORDER BY position, rank, place) AS again
    FROM (SELECT *, instr(body, raw_text) AS position FROM matches)
  ) WHERE again = 1
)"""


EXTRACTED_SQL = _references_sql()

RESOLVED_SQL = """
targets AS (SELECT *, CASE WHEN kind = 'internal_self' AND dieu IS NOT NULL THEN regexp_replace(target_citation, 'này$', dieu) ELSE target_citation END AS target FROM extracted
), sourced AS (
  SELECT t.*, c.clause_id AS src_clause_id, row_number() OVER (PARTITION BY t.document_id, c.clause_id, t.raw_text, t.target ORDER BY t.ord, t.no) AS again
  FROM targets t JOIN clauses c ON c.document_id = t.document_id AND c.citation = t.citation
), refs AS (
  SELECT s.document_id, s.src_clause_id, d.clause_id AS dst_clause_id, CASE WHEN d.clause_id IS NULL THEN 'external' ELSE 'internal' END AS kind, s.raw_text, s.target AS target_citation, s.ord, s.no AS place
  FROM sourced s LEFT JOIN clauses d ON d.document_id = s.document_id AND d.citation = s.target AND s.kind <> 'external'
  WHERE s.again = 1
)"""


def _first_named(names, otherwise, said=None) -> str:
    cases = " ".join(f"WHEN contains(lower(prose), '{n}') THEN '{(said or {}).get(n, n)}'" for n in names)
    return f"CASE {cases} ELSE {otherwise} END"


_LINE = STRIP(f"split_part({STRIP('prose')}, chr(10), 1)")
CARDS_SQL = f"""
prose AS (SELECT * FROM (SELECT *, {STRIP(f"regexp_replace(body, '{X.HEADER_LEAD}', '')")} AS prose FROM clauses WHERE kind = 'dieu') WHERE prose <> ''
), gloss AS (
  SELECT *, CASE WHEN dot > 0 AND dot <= 280 THEN left(said, dot) WHEN part > 0 AND part <= 280 THEN left(said, part) ELSE left(said, 280) END AS cut
  FROM (SELECT *, instr(said, '. ') - 1 AS dot, instr(said, '; ') - 1 AS part FROM (SELECT *, {_LINE} AS said FROM prose))
), cards AS (
  SELECT clause_id AS card_id, clause_id, document_id, citation, body, citation || ': ' || {STRIP("cut")} AS statement, {_first_named(X.ACTORS, f"'{X.DEFAULT_ACTOR}'")} AS bound_actor,
         {_first_named(X.TOPICS, "NULL", X.TOPIC_NAMES)} AS topic, '{X.FACT_PREFIX}' || citation AS fact, nullif({STRIP(f"regexp_extract(prose, '(?i)phạt{WS}+[^.{chr(92)}n]{{4,200}}', 0)")}, '') AS penalty
  FROM gloss
)"""

ARTICLES_SQL = f"""
articles AS (
  SELECT document_id, ord, try_cast(number AS INTEGER) AS num, page_start, greatest(coalesce(max(page_end) OVER (PARTITION BY document_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 1) AS lo
  FROM clauses WHERE kind = 'dieu' AND try_cast(number AS INTEGER) IS NOT NULL
), chapter_pages AS (SELECT DISTINCT document_id, page FROM lines WHERE regexp_matches(line, '^{WS}*Chương{WS}+[IVXLCDM]+\\b')
), marked AS (SELECT a.document_id, a.ord FROM articles a WHERE EXISTS (SELECT 1 FROM chapter_pages c WHERE c.document_id = a.document_id AND c.page BETWEEN a.lo AND a.page_start)
), spans AS (
  SELECT document_id, num + 1 AS first_missing, (SELECT min(x.num) FROM articles x WHERE x.document_id = a.document_id AND x.num > a.num) - 1 AS last_missing
  FROM (SELECT DISTINCT document_id, num::BIGINT AS num FROM articles) a
), gaps AS (
  SELECT e.document_id, e.first_missing, e.last_missing, max(a.ord) FILTER (WHERE a.num < e.first_missing) AS before_ord, min(a.ord) FILTER (WHERE a.num > e.last_missing) AS after_ord
  FROM spans e JOIN articles a USING (document_id) WHERE e.last_missing >= e.first_missing GROUP BY ALL
), numbering AS (
  SELECT g.*, g.before_ord IS NOT NULL AND m.ord IS NOT NULL AS by_chapter FROM gaps g LEFT JOIN marked m ON m.document_id = g.document_id AND m.ord = g.after_ord
)"""

BAG_SQL = r"""
tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM documents
)"""


def over(*steps: str, select: str) -> str:
    return "WITH RECURSIVE " + ", ".join(steps) + "\n" + select


def lines_up(*steps: str, select: str) -> str:
    return over(LINES_SQL, *steps, select=select)
