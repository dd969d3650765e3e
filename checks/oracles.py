"""DuckDB SQL with the rows that every query must give.

Where a query reads derived texts, the SQL says what was put into them, or works line by line
with windows and recursion; it does not repeat the array expressions of the library.
"""

from checks import inputs as I
from checks import queries as Q
from lawloom import constants as C

# White space in the RE2 dialect.
W = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)||chr(12288)"
MARKS = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
LETTERS = "[^0-9A-Za-z가-힣ㄱ-ㅎㅏ-ㅣ]+"
NOISE = "|".join(C.NOISE_TOKENS)


def collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{W}+', ' ', 'g'), ' ')"


def spaced(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{LETTERS}', ' ', 'g'), ' ')"


def letters_only(x: str) -> str:
    deleted = f"regexp_replace(regexp_replace(coalesce({x}, ''), '{W}+', ' ', 'g'), '[^가-힣A-Za-z0-9 ]+', '', 'g')"
    return f"trim(regexp_replace({deleted}, ' +', ' ', 'g'), ' ')"


def key(x: str) -> str:
    return f"lower(replace({spaced(x)}, ' ', ''))"


DOCS = """
docs AS (
  SELECT doc_id, list_transform(string_split(replace(text, '. ', '.' || chr(10)), chr(10)), lambda x: trim(x, ' ')) AS a
  FROM documents),
dl AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS i, unnest(a) AS l FROM docs)"""

DECORATED = """
decorated AS (
  SELECT doc_id, replace(replace(text, ', ', ',' || chr(8203) || ' •<LAW_1>  '), chr(10),
    chr(10) || '---' || chr(10) || chr(10) || chr(10) || chr(9) || chr(12288) || '★ ') AS text
  FROM documents)"""

LAW_LINES = rf"""
raw_law AS (
  SELECT doc_id, i, '법령' || doc_id AS law_name, CASE
    WHEN i % 23 = 5 THEN i::VARCHAR
    WHEN i % 29 = 7 THEN '법제처 국가법령정보센터'
    WHEN i % 31 = 9 THEN '법령' || doc_id
    WHEN i % 17 = 0 THEN '제' || (i // 17 + 1) || '장 ' || l
    WHEN i % 4 = 0 THEN '제' || (i // 4 + 1 + CASE WHEN (doc_id + i) % 11 = 0 THEN 30 ELSE 0 END) || '조(' ||
      translate(l, '()', '') || ')'
    WHEN i % 4 <= 2 THEN substr('{MARKS}', (i % 4)::INT, 1) || ' ' || l
    ELSE l END AS raw
  FROM dl),
all_lines AS (SELECT doc_id, i, law_name, trim(raw, ' ') AS line FROM raw_law WHERE trim(raw, ' ') <> ''),
page_lines AS (
  SELECT * FROM all_lines
  WHERE line <> law_name AND NOT regexp_matches(line, '법제처|국가법령정보센터') AND NOT regexp_matches(line, '^[0-9]+$')),
law_lines AS (SELECT doc_id, law_name, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS line_no, line FROM page_lines)"""


def _segment(source: str, strict: bool) -> str:
    """Windows over a line table; the heading guard walks the candidates one by one."""
    heading = r"^제\s*[0-9]+\s*조(\s*\(.*?\))?\s*$" if strict else r"^제\s*[0-9]+\s*조"
    parts = r"^제\s*([0-9]+)\s*조(?:\((.+?)\))?\s*(.*)$" if strict else r"^제([0-9]+)조(?:\((.*?)\))?\s*(.*)$"
    guard = """
r AS (
  SELECT doc_id, k, i, num AS last, true AS ok FROM cand WHERE k = 1
  UNION ALL
  SELECT c.doc_id, c.k, c.i, CASE WHEN abs(c.num - r.last) <= 5 THEN c.num ELSE r.last END, abs(c.num - r.last) <= 5
  FROM r JOIN cand c ON c.doc_id = r.doc_id AND c.k = r.k + 1),""" if strict else "r AS (SELECT doc_id, k, i, true AS ok FROM cand),"
    return rf"""WITH RECURSIVE {DOCS}, {LAW_LINES},
ln AS (SELECT doc_id, law_name, i, line, regexp_matches(line, '^제\s*[0-9]+\s*장') AS is_ch,
  regexp_matches(line, '{heading}') AND NOT regexp_matches(line, '^제\s*[0-9]+\s*장') AS is_cand FROM {source}),
cand AS (SELECT doc_id, i, regexp_extract(line, '[0-9]+')::BIGINT AS num, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM ln WHERE is_cand),
{guard}
typed AS (
  SELECT ln.*, CASE WHEN is_ch THEN 'C' WHEN r.ok THEN 'A' WHEN regexp_matches(line, '^[①-⑳]') THEN 'K' ELSE 'P' END AS t
  FROM ln LEFT JOIN r ON r.doc_id = ln.doc_id AND r.i = ln.i),
seq AS (
  SELECT *, sum(CASE WHEN t IN ('C', 'A') THEN 1 ELSE 0 END) OVER w AS b, sum(CASE WHEN t = 'A' THEN 1 ELSE 0 END) OVER w AS s,
    sum(CASE WHEN t = 'K' THEN 1 ELSE 0 END) OVER w AS kk,
    last_value(CASE WHEN t = 'C' THEN line END IGNORE NULLS) OVER w AS chapter,
    last_value(CASE WHEN t = 'A' THEN line END IGNORE NULLS) OVER w AS heading
  FROM typed WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
marked AS (
  SELECT *, last_value(CASE WHEN t = 'K' THEN substr(line, 1, 1) END IGNORE NULLS)
    OVER (PARTITION BY doc_id, s ORDER BY i ROWS UNBOUNDED PRECEDING) AS mark FROM seq),
pieces AS (
  SELECT doc_id, law_name, b, kk, mark, chapter, heading, i, CASE WHEN t = 'K' THEN trim(substr(line, 2), ' ') ELSE line END AS text
  FROM marked WHERE t IN ('K', 'P') {"AND NOT (t = 'P' AND s = 0)" if strict else ""}),
joined AS (
  SELECT doc_id, law_name, b, CASE WHEN mark IS NULL THEN -1 ELSE kk END AS kk, mark, chapter, heading,
    string_agg(text, ' ' ORDER BY i) AS text
  FROM pieces WHERE text <> '' GROUP BY ALL)
SELECT doc_id, law_name, row_number() OVER (PARTITION BY doc_id ORDER BY b, (mark IS NULL), kk) - 1 AS ord, chapter,
  '제' || nullif(regexp_extract(heading, '{parts}', 1), '') || '조' AS article_number,
  coalesce(nullif(trim(regexp_extract(heading, '{parts}', 2)), ''), nullif(trim(regexp_extract(heading, '{parts}', 3)), '')) AS article_title,
  mark AS clause_number, text FROM joined"""


def _rows(forms: list[str], value: str) -> str:
    cases = " ".join(f"WHEN i % {len(forms)} = {k} THEN replace('{f}', '@', l)" for k, f in enumerate(forms))
    return f"WITH {DOCS}, v AS (SELECT doc_id, i, CASE {cases} END AS c FROM dl) SELECT doc_id, i, {value} AS value FROM v"


CLAUSES = f"""
ct AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '머리글 ' ELSE '' END ||
    CASE WHEN doc_id % 4 = 1 THEN array_to_string(a, ' ') ELSE
      array_to_string(list_transform(a, lambda x, n: substr('{MARKS}', (((n - 1) % 20) + 1)::INT, 1) || ' ' || x), ' ')
      || CASE WHEN doc_id % 7 = 0 THEN ' 생략' ELSE '' END END AS text,
    doc_id % 4 = 1 OR doc_id % 7 = 0 OR len(list_filter(a, lambda x: x <> '')) = 0 AS whole
  FROM docs),
cl AS (
  SELECT doc_id, 0 AS pos, NULL::VARCHAR AS mark, {collapse('text')} AS text FROM ct WHERE whole
  UNION ALL
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1, substr('{MARKS}', (i % 20 + 1)::INT, 1), {collapse('l')}
  FROM dl JOIN ct USING (doc_id) WHERE NOT whole AND {collapse('l')} <> '')"""

HTML_ROWS = f"""
hl AS (SELECT doc_id, i, {collapse('l')} AS l,
  '제' || (i // 6 + 1) || '장' || rtrim(' ' || {collapse("first_value(l) OVER (PARTITION BY doc_id, i // 6 ORDER BY i)")}) AS chapter FROM dl),
hr AS (
  SELECT doc_id, i, 1 AS n, '본칙' AS section, chapter, '제' || i || '조' AS article_number, '목적' || i AS article_title,
    '1항' AS clause_number, l AS text FROM hl WHERE i % 6 BETWEEN 1 AND 3 AND l <> ''
  UNION ALL SELECT doc_id, i, 2, '본칙', chapter, '제' || i || '조', '목적' || i, '2항', rtrim('제' || i || '호 ' || l) FROM hl WHERE i % 6 BETWEEN 1 AND 3
  UNION ALL SELECT doc_id, i, 1, '본칙', chapter, '제' || i || '조의2', '정의', '', l FROM hl WHERE i % 6 = 4
  UNION ALL SELECT doc_id, i, 1, '부칙', '법률 제' || i || '호 (갑법)', '제1조', '시행일', '전문', l FROM hl WHERE i % 6 = 5
  UNION ALL SELECT doc_id, i, 2, '부칙', '법률 제' || i || '호 (갑법)', '제1조', '시행일', '', l FROM hl WHERE i % 6 = 5
  UNION ALL SELECT doc_id, i, 3, '부칙', '법률 제' || i || '호 (갑법)', '제2조', '', '전문', '제2조부터 제3조까지 생략' FROM hl WHERE i % 6 = 5
  UNION ALL SELECT doc_id, i, 4, '부칙', '법률 제' || i || '호 (갑법)', '제2조', '', '', '제2조부터 제3조까지 생략' FROM hl WHERE i % 6 = 5),
ho AS (
  SELECT doc_id, '법령' || doc_id AS law_name, row_number() OVER (PARTITION BY doc_id ORDER BY i, n) - 1 AS ord, section, chapter,
    article_number, article_title, clause_number, text FROM hr)"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


HEADERS, LABELS = _list(I.FIELD_HEADERS), _list(I.PAIR_LABELS)
HEADER_FIELDS = _list(["서비스 내용", "특례 내용", "부가조건", "규제", "기대효과", "개선결과"])
ALIASES = ", ".join(f"('{f}', {n}, '{a}')" for f, al in C.FIELD_ALIASES.items() for n, a in enumerate(al))

SECTIONS = f"""
titles AS (SELECT doc_id, {key('a[1]')} AS title_key FROM docs),
paras AS (
  SELECT doc_id, i, i // 4 AS sec, CASE
    WHEN i % 4 = 0 THEN trim(': ' || l, ' :：-–—·•' || chr(160))
    WHEN i = 1 THEN '개선 사항 : ' || l
    WHEN i % 4 = 1 THEN l
    WHEN i % 4 = 2 THEN '첨부파일 ' || l
    ELSE l || ' & 끝' END AS own FROM dl),
kept AS (
  SELECT doc_id, sec, i, {collapse('own')} AS own FROM paras JOIN titles USING (doc_id)
  WHERE {collapse('own')} <> '' AND NOT regexp_matches(own, '{NOISE}') AND {key('own')} <> title_key),
secs AS (
  SELECT doc_id, sec, {HEADERS}[(sec % 7 + 1)::INT] AS header, string_agg(own, ' ' ORDER BY i) AS body FROM kept GROUP BY ALL)"""

PAIRS = f"""
pr AS (
  SELECT doc_id, i, 1 AS n, {LABELS}[(i // 5 % 6 + 1)::INT] AS label, {collapse("l || ' ' || i")} AS value FROM dl WHERE i % 5 = 0
  UNION ALL SELECT doc_id, i, 1, '조건', {collapse('l')} FROM dl WHERE i % 5 = 1
  UNION ALL SELECT doc_id, i, 2, '효과', i::VARCHAR FROM dl WHERE i % 5 = 1),
pairs AS (SELECT * FROM pr WHERE value <> '' AND NOT regexp_matches(value, '{NOISE}'))"""

CONTAINER = f"""
container AS (
  SELECT doc_id, {collapse('''string_agg(t, ' ' ORDER BY part, i)''')} AS text FROM (
    SELECT doc_id, 1 AS part, i, CASE WHEN i % 4 = 0 THEN {HEADERS}[(i // 4 % 7 + 1)::INT] || ' : ' || l
      WHEN i = 1 THEN '개선 사항 : ' || l WHEN i % 4 = 1 THEN l WHEN i % 4 = 2 THEN '첨부파일 ' || l ELSE l || ' & 끝' END AS t FROM dl
    UNION ALL SELECT doc_id, 2, i, CASE WHEN i % 5 = 0 THEN {LABELS}[(i // 5 % 6 + 1)::INT] || ' ' || l || ' ' || i
      WHEN i % 5 = 1 THEN '조건 효과 ' || l || ' ' || i ELSE l END FROM dl) GROUP BY doc_id)"""

FIELDS = f"""
aliases(field, n, alias) AS (VALUES {ALIASES}),
fields AS (SELECT unnest({_list(C.FIELDS)}) AS field),
strong AS (
  SELECT doc_id, CASE sec % 7 {" ".join(f"WHEN {k} THEN '{f}'" for k, f in enumerate(C.FIELDS))} END AS field,
    string_agg(body, ' ' ORDER BY sec) AS value FROM secs GROUP BY ALL),
paired AS (
  SELECT doc_id, field, max_by(value, i * 10 + n) AS value FROM (
    SELECT DISTINCT p.doc_id, a.field, p.i, p.n, p.value FROM pairs p JOIN aliases a ON contains(p.label, a.alias)) GROUP BY ALL),
heads AS (
  SELECT dl.doc_id, dl.i, CASE WHEN dl.i = 1 THEN '개선 사항' ELSE {HEADERS}[(dl.i // 4 % 7 + 1)::INT] END AS head,
    coalesce(nullif({collapse('dl.l')}, ''), (SELECT min_by(p.own, p.i) FROM paras p WHERE p.doc_id = dl.doc_id AND p.i > dl.i AND trim(p.own) <> '')) AS value
  FROM dl WHERE dl.i % 4 = 0 OR dl.i = 1),
labelled AS (
  SELECT doc_id, field, min_by(value, n) AS value FROM (
    SELECT h.doc_id, a.field, a.n, min_by({collapse('h.value')}, h.i) AS value
    FROM heads h JOIN aliases a ON suffix(h.head, a.alias) WHERE h.value IS NOT NULL GROUP BY ALL)
  WHERE NOT regexp_matches(value, '{NOISE}') GROUP BY ALL),
found AS (
  SELECT d.doc_id, f.field, CASE WHEN s.value IS NOT NULL THEN s.value WHEN p.value IS NOT NULL THEN p.value
      WHEN l.value IS NOT NULL THEN l.value ELSE '' END AS value,
    CASE WHEN s.value IS NOT NULL THEN 'strong' WHEN p.value IS NOT NULL THEN 'pairs' WHEN l.value IS NOT NULL THEN 'label' ELSE 'empty' END AS src
  FROM docs d CROSS JOIN fields f LEFT JOIN strong s ON s.doc_id = d.doc_id AND s.field = f.field
  LEFT JOIN paired p ON p.doc_id = d.doc_id AND p.field = f.field LEFT JOIN labelled l ON l.doc_id = d.doc_id AND l.field = f.field)"""

FIN_LINES = f"""
fl AS (
  SELECT doc_id, i % 5 AS k, (row_number() OVER (PARTITION BY doc_id, i % 5 ORDER BY i) - 1) AS j, l FROM dl),
fv AS (
  SELECT doc_id, k, string_agg({{clean}}, chr(10) ORDER BY j) AS v FROM fl GROUP BY ALL),
fin AS (
  SELECT d.doc_id, {", ".join(f"coalesce(trim(max(CASE WHEN k = {k} THEN v END), ' ' || chr(10)), '') AS v{k}" for k in range(5))}
  FROM docs d LEFT JOIN fv ON fv.doc_id = d.doc_id GROUP BY d.doc_id)"""
BULLETS = r"^(?:\s*(?:[\-–—•·/]|[①-⑳]|\(?[0-9]{1,3}\)?[.)]|[가-힣]\))\s*)+"
CLEAN = rf"trim(regexp_replace(regexp_replace({collapse('l')}, '{BULLETS}', ''), '[ \t]+', ' ', 'g'), ' ')"
FIN = FIN_LINES.replace("{clean}", CLEAN)

CASES = f"""
cb AS (
  SELECT doc_id AS page_id, i AS pos, {collapse('l')} AS l, i % 9 <> 7 AS shown, CASE WHEN i % 8 = 3 THEN '' ELSE ' 허용' END AS allowed FROM dl)"""

CASE_PARTS = rf"""
parts AS (
  SELECT page_id, pos, CASE pos % 4 WHEN 1 THEN '[' || l || ']' WHEN 2 THEN '제목 ' || pos
      ELSE CASE WHEN regexp_matches(l, '\[[^\]]+\]') THEN {collapse(r"regexp_extract(l, '\[([^\]]+)\]', 1)")}
        ELSE trim(substr(regexp_extract({collapse("l || ' ☞ ' || l || allowed")}, '^(.+?)([.!?。…]|$)', 1), 1, 120), ' ') END
      END AS subtitle,
    CASE pos % 4 WHEN 1 THEN {collapse(r"regexp_replace(l, '^[:\-–—·.)]*\s*', '') || ' ' || l")} WHEN 2 THEN CASE WHEN l = '' THEN ':' ELSE l END ELSE '' END AS stat,
    CASE WHEN pos % 4 = 2 THEN CASE WHEN l = '' THEN '-' ELSE l || ' ' || l END WHEN l = '' OR allowed = '' THEN '' ELSE l || ' 허용' END AS allow
  FROM cb WHERE pos % 4 <> 0)"""

PRE = rf"""
halves AS (
  SELECT doc_id, a[1] AS first_line, {collapse("array_to_string(list_filter(a, lambda x, n: n % 2 = 1), ' ')")} AS f,
    {collapse("array_to_string(list_filter(a, lambda x, n: n % 2 = 0), ' ')")} AS s FROM docs),
pre AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN doc_id || '~' || (doc_id + 1) || '. ' || first_line WHEN 1 THEN '0' || doc_id || ') ' || first_line
      ELSE first_line END AS title,
    CASE doc_id % 5 WHEN 2 THEN regexp_replace(f, '^[:：-]\s*', '') WHEN 3 THEN trim(f || ' ' || s, ' ') WHEN 4 THEN trim(f || ' ' || s, ' ') ELSE f END AS rel,
    CASE doc_id % 5 WHEN 0 THEN s WHEN 1 THEN regexp_replace(s, '^[:：-]\s*', '') WHEN 2 THEN s ELSE '' END AS spec
  FROM halves)"""


ORACLES = {
    "text_clean": f"WITH {DECORATED} SELECT doc_id, {collapse('text')} AS text FROM decorated",
    "text_strip_special": f"WITH {DECORATED} SELECT doc_id, {spaced('text')} AS text FROM decorated",
    "text_strip_delete": f"WITH {DECORATED} SELECT doc_id, {letters_only('text')} AS text FROM decorated",
    "text_normkey": f"WITH {DECORATED} SELECT doc_id, {key('text')} AS text FROM decorated",
    "text_law_tags": f"WITH {DECORATED} SELECT doc_id, replace(text, '<LAW_1>', '') AS text FROM decorated",
    "text_sanitize": rf"""WITH {DECORATED},
      t1 AS (SELECT doc_id, regexp_replace(replace(replace(replace(text, chr(8203), ''), '•', ''), '★', ''), '[{C.GLYPHS}]', '', 'g') AS t FROM decorated),
      t2 AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?m)^[-=_]{{2,}}$', '', 'g'), '(?i)</?LAW[^>]*>', '', 'g') AS t FROM t1)
      SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[ \t]{{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), {WS}) AS text FROM t2""",
    "text_keep_law": rf"""WITH {DOCS}, {LAW_LINES},
      b AS (SELECT doc_id, i, CASE WHEN i % 2 = 1 THEN ' - (1) 가) ' || raw ELSE raw END AS t FROM raw_law),
      c AS (SELECT doc_id, i, trim(CASE WHEN regexp_matches(t, '^\s*제\s*[0-9]+\s*조') THEN t
        ELSE regexp_replace(regexp_replace(trim(t, ' '), ' +', ' ', 'g'), '{BULLETS}', '') END, ' ') AS t FROM b)
      SELECT doc_id, trim(regexp_replace(string_agg(regexp_replace(t, ' +', ' ', 'g'), chr(10) ORDER BY i), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text
      FROM c GROUP BY doc_id""",
    "null_tokens": _rows(Q.NULL_FORMS, rf"CASE WHEN regexp_matches(trim(c, ' '), '^(-|(없음|해당없음|해당 없음|미해당)[.\s]*)?$') THEN '' ELSE trim(c, ' ') END"),
    "leading_index": _rows(Q.INDEX_FORMS, r"regexp_replace(c, '^\s*[0-9]+(?:\s*[~\-–—]\s*[0-9]+)?\s*[.)\-:ㆍ·]?\s*', '')"),
    "major_title": _rows(Q.ROUND_FORMS, rf"regexp_replace({collapse('c')}, '^\s*(?:[0-9]+|[①-⑳])\s*차\s*[-–—·.)]*\s*', '')"),
    "mid_title": _rows(
        Q.TRIAL_FORMS,
        rf"coalesce(nullif(regexp_replace({collapse('c')}, '^\s*[①-⑳]?\s*[(\[]?\s*실증\s*특례\s*[)\]]?\s*[-–—:·.)]*\s*', ''), ''), {collapse('c')})",
    ),
    "first_sentence": f"SELECT doc_id, trim(substr(regexp_extract({collapse('text')}, '^(.+?)([.!?。…]|$)', 1), 1, 120), ' ') AS sentence FROM documents",
    "filename_clean": f"""SELECT doc_id, coalesce(nullif(trim(regexp_replace(text, '[<>:"/\\\\|?*]', '', 'g'), {WS}), ''), '법령') AS file_name FROM documents""",
    "docname_short": r"""SELECT doc_id, substr(replace(regexp_replace('법 (가) 나(' || text || ')', '\([^\n]*?\)', '', 'g'), ' ', '_'), 1, 50) AS name FROM documents""",
    "url_build": """SELECT doc_id, 'https://x.example/?q=' || replace(url_encode(text), '%20', '+') AS search_url,
      'https://www.law.go.kr/법령/' || replace(url_encode(text), '%2F', '/') AS detail_url FROM documents""",
    "url_join": "SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN 'https://www.sandbox.or.kr/board/designated_case_edit.do?bdSeq=' || p_partkey END AS url FROM part",
    "date_norm": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y.%m') END AS date FROM orders",
    "separators": f"""WITH {DOCS} SELECT doc_id, i, trim(' :-  · ' || l || ' —: 기대 효과 •', ' :：-–—·•' || chr(160)) AS value FROM dl""",
    "noise_lines": _rows(["조회수 @", " ", "@"], f"CASE WHEN trim(c, ' ') = '' OR regexp_matches(c, '{NOISE}') THEN 'noise' ELSE 'text' END"),
    "law_lines": f"WITH {DOCS}, {LAW_LINES} SELECT doc_id, line_no, line FROM law_lines",
    "law_segment": _segment("page_lines", True),
    "law_segment_loose": _segment("all_lines", False),
    "law_segment_pages": f"SELECT {', '.join(C.LAW_ROW_COLUMNS)} FROM ({_segment('page_lines', True)})",
    "law_unnumbered_pages": f"SELECT {', '.join(C.LAW_ROW_COLUMNS)} FROM ({_segment('page_lines', True)})",
    "law_segment_paragraphs": f"SELECT {', '.join(C.LAW_ROW_COLUMNS)} FROM ({_segment('all_lines', False)})",
    "article_title": rf"""WITH {DOCS}, {LAW_LINES}, p AS (
        SELECT doc_id, line_no, line, regexp_extract(line, '^제\s*([0-9]+)\s*조', 1) AS num,
          regexp_extract(line, '^제\s*[0-9]+\s*조(?:\((.+?)\))?\s*(.*)$', 1) AS title,
          trim(regexp_extract(line, '^제\s*[0-9]+\s*조(?:\((.+?)\))?\s*(.*)$', 2), ' ') AS rest FROM law_lines)
      SELECT doc_id, line_no, CASE WHEN num <> '' THEN '제' || num || '조' ELSE line END AS article_number,
        CASE WHEN title <> '' THEN trim(title, ' ') ELSE rest END AS article_title, CASE WHEN title <> '' THEN rest ELSE '' END AS body FROM p""",
    "law_outcomes": """SELECT d.doc_id::VARCHAR AS key, 'failed' AS status,
      CASE WHEN l.quality IS NULL THEN 'no text' ELSE 'blank text' END AS error
      FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR l.quality = 0""",
    "clause_split": f"WITH {DOCS}, {CLAUSES} SELECT doc_id, pos, mark, text FROM cl",
    "clause_marks": f"""WITH {DOCS}, {CLAUSES} SELECT CASE WHEN mark IS NULL THEN '' ELSE strpos('{MARKS}', mark) || '항' END AS label,
      count(*) AS n FROM cl GROUP BY 1""",
    "article_fulltext": f"WITH {DOCS}, {CLAUSES} SELECT doc_id, string_agg(text, ' ' ORDER BY pos) AS text FROM cl GROUP BY doc_id",
    "law_html_rows": f"WITH {DOCS}, {HTML_ROWS} SELECT * FROM ho WHERE section = '본칙'",
    "law_supplement_rows": f"WITH {DOCS}, {HTML_ROWS} SELECT * FROM ho WHERE section = '부칙'",
    "html_blocks": r"""WITH p AS (
        SELECT page_id, regexp_extract_all(regexp_replace(html,
          '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<!doctype[^>]*>', '', 'g'),
          '<(/?)([A-Za-z][A-Za-z0-9]*)([^>]*)>([^<]*)') AS t FROM pages),
      u AS (SELECT page_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS t FROM p)
      SELECT page_id, pos, regexp_extract(t, '^<(/?)', 1) = '/' AS is_close, lower(regexp_extract(t, '^</?([A-Za-z0-9]+)', 1)) AS tag,
        trim(regexp_extract(t, '^</?[A-Za-z0-9]+([^>]*)>', 1), ' ') AS attrs, replace(replace(regexp_extract(t, '>([^<]*)$', 1), '&copy;', chr(169)), '&middot;', chr(183)) AS text FROM u""",
    "html_text": rf"""SELECT page_id, {collapse('''replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html,
        '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<!doctype[^>]*>', '', 'g'), '<[^>]*>', ' ', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&nbsp;', chr(160)), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')''')} AS text FROM pages""",
    "html_links": r"""WITH u AS (
        SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS a FROM pages),
      v AS (SELECT page_id, generate_subscripts(a, 1) AS i, unnest(a) AS url FROM u),
      f AS (SELECT page_id, url, min(i) AS i FROM v GROUP BY ALL)
      SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, url FROM f""",
    "detail_links": f"""WITH {DOCS}, e AS (
        SELECT doc_id, 1 AS part, i, doc_id * 100 + i % 40 AS id FROM dl
        UNION ALL SELECT doc_id, 2, 0, doc_id * 100 + 77 FROM docs),
      f AS (SELECT doc_id, id, min(part * 1000000 + i) AS o FROM e GROUP BY ALL)
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY o) - 1 AS pos,
        'https://sandbox.fintech.or.kr/business/enterprise.do?lang=ko&id=' || id AS url FROM f""",
    "html_list_rows": f"""WITH {DOCS},
      n AS (SELECT doc_id, i, {collapse('l')} AS l, CASE WHEN i % 7 <> 3 THEN (doc_id * 10000 + i)::VARCHAR END AS id FROM dl WHERE i % 5 <> 4),
      stops AS (SELECT d.doc_id % 2 AS form, min(d.doc_id) AS stop FROM docs d LEFT JOIN (SELECT DISTINCT doc_id FROM n) x USING (doc_id)
        WHERE x.doc_id IS NULL GROUP BY 1)
      SELECT CASE WHEN doc_id % 2 = 0 THEN 'FORM_002' ELSE 'FORM_003' END AS form_code, id AS "bdSeq", i::VARCHAR AS "번호", '임시허가' AS "구분",
        '회사 ' || i AS "기업명", l AS "서비스명", '2024-01-31' AS designated_date,
        'https://www.sandbox.or.kr/board/designated_case_edit.do?bdSeq=' || id AS detail_url,
        i || ' | 임시허가 | 회사 ' || i || ' | ' || l || ' | 보기 | 20240131' AS list_td_text, doc_id AS page_no,
        row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos
      FROM n LEFT JOIN stops ON stops.form = doc_id % 2 WHERE stop IS NULL OR doc_id < stop""",
    "list_signature": r"""SELECT page_id, array_to_string(list_transform(regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1)[1:5], lambda x: trim(x)), '|') AS signature FROM pages""",
    "kv_last_wins": "SELECT user_id, event_type, max_by(props, event_id) AS props FROM events GROUP BY ALL",
    "kv_table": f"""WITH {DOCS}, {FIN}
      SELECT doc_id, pos, label, value FROM (
        SELECT doc_id, 0 AS pos, '지정제도' AS label, v0 AS value FROM fin UNION ALL SELECT doc_id, 1, '서비스명', v1 FROM fin
        UNION ALL SELECT doc_id, 2, '서비스주요내용', v2 FROM fin UNION ALL SELECT doc_id, 3, '지정일자', '20240131' FROM fin
        UNION ALL SELECT doc_id, 4, '규제특례내용', CASE WHEN doc_id % 4 = 0 THEN '해당 없음.' ELSE v3 END FROM fin
        UNION ALL SELECT doc_id, 5, CASE WHEN doc_id % 3 = 0 THEN '기타' ELSE '주요부가조건내용' END, v4 FROM fin)""",
    "kv_pairs": f"WITH {DOCS}, {PAIRS} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, n) - 1 AS pos, label, value FROM pairs",
    "strong_sections": f"WITH {DOCS}, {SECTIONS} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1 AS pos, header, body FROM secs",
    "header_map": f"""WITH {DOCS}, {SECTIONS} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec) - 1 AS pos,
      {HEADER_FIELDS}[(sec % 7 + 1)::INT] AS field FROM secs""",
    "best_container": f"WITH {DOCS}, {CONTAINER} SELECT doc_id, CASE WHEN length(text) >= 4 THEN text ELSE '짧은 칸' END AS text FROM container",
    "best_container_loose": f"""WITH {DOCS}, joined AS (SELECT doc_id, {collapse("string_agg(l || ' ' || i, ' ' ORDER BY i)")} AS text FROM dl GROUP BY doc_id)
      SELECT doc_id, CASE WHEN length(text) > 4 THEN text ELSE '짧은 칸' END AS text FROM joined""",
    "best_table": f"""WITH {DOCS}, fl AS (
        SELECT doc_id, i % 5 AS k, (row_number() OVER (PARTITION BY doc_id, i % 5 ORDER BY i) - 1) AS j, l FROM dl),
      fv AS (SELECT doc_id, k, string_agg(CASE WHEN j % 2 = 0 THEN '- ' ELSE '' END || l, ' ' ORDER BY j) AS v FROM fl GROUP BY ALL),
      f AS (SELECT d.doc_id, {", ".join(f"coalesce(max(CASE WHEN k = {k} THEN v END), '') AS v{k}" for k in range(5))} FROM docs d LEFT JOIN fv ON fv.doc_id = d.doc_id GROUP BY d.doc_id),
      s AS (SELECT doc_id, {collapse('''concat('지정 제도 ', v0, ' 서비스명 ', v1, ' 서비스 주요 내용 ', v2, ' 지정 일자 20240131 규제 특례 내용 ',
        CASE WHEN doc_id % 4 = 0 THEN '해당 없음.' ELSE v3 END, ' ', CASE WHEN doc_id % 3 = 0 THEN '기타' ELSE '주요 부가 조건 내용' END, ' ', v4)''')} AS t,
        regexp_matches(v0, 'No|NO|no') AS odd FROM f)
      SELECT doc_id, t AS section_text, CASE WHEN odd THEN t ELSE '공지 서비스' END AS list_text FROM s""",
    "financial_fields": f"""WITH {DOCS}, {FIN}
      SELECT doc_id, CASE WHEN v1 = '' THEN '서비스 이름' ELSE v1 END AS "서비스명", v0 AS "지정 제도", v2 AS "서비스 주요 내용",
        CASE WHEN doc_id % 4 = 0 THEN '' WHEN v3 = '' THEN '규제 특례 내용' ELSE v3 END AS "규제 특례 내용",
        v4 AS "주요 부가 조건 내용" FROM fin""",
    "field_fallback": f"""WITH {DOCS}, {SECTIONS}, {PAIRS}, {FIELDS}
      SELECT doc_id, {", ".join(f'''max(CASE WHEN field = '{f}' THEN value END) AS "{f}"''' for f in C.FIELDS)},
        {", ".join(f'''max(CASE WHEN field = '{f}' THEN src END) AS "src_{f}"''' for f in C.FIELDS)} FROM found GROUP BY doc_id""",
    "provenance_cols": f"""WITH {DOCS}, {SECTIONS}, {PAIRS}, {FIELDS}
      SELECT doc_id, coalesce(string_agg(CASE WHEN value <> '' THEN field END, '|' ORDER BY list_position({_list(C.FIELDS)}, field)), '') AS extracted_columns,
        {", ".join(f'''{spaced(f"max(CASE WHEN field = '{f}' THEN value END)")} AS "{f}"''' for f in C.FIELDS)} FROM found GROUP BY doc_id""",
    "subtitle": f"WITH {DOCS}, {CASES}, {CASE_PARTS} SELECT page_id, pos, subtitle FROM parts",
    "stat_allow": f"""WITH {DOCS}, {CASES}, {CASE_PARTS} SELECT page_id, pos, stat AS "현황", allow AS "허용" FROM parts""",
    "case_rows": rf"""WITH {DOCS}, {CASES}, {CASE_PARTS},
      h AS (SELECT page_id, pos, l, last_value(CASE WHEN pos % 12 = 8 THEN '' WHEN pos % 4 = 0 THEN
          coalesce(nullif(regexp_replace(l, '^[)\]]?\s*[-–—:·.)]*\s*', ''), ''), '실증특례') END IGNORE NULLS)
          OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS mid FROM cb WHERE shown)
      SELECT page_id, pos, '구역 ' || page_id AS "대제목", mid AS "중제목", subtitle AS "소제목", stat AS "현황", allow AS "허용"
      FROM h JOIN parts USING (page_id, pos) WHERE mid <> '' AND pos % 4 <> 0""",
    "stat_allow_flat": f"""WITH {DOCS} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN {collapse("array_to_string(a, ' ')")} ELSE '' END AS "현황",
      CASE WHEN doc_id % 2 = 0 THEN {collapse("array_to_string(a, ' ')")} ELSE '' END AS "허용" FROM docs""",
    "two_headings": f"""WITH {DOCS}, {PRE} SELECT doc_id, rel AS "관계법령_raw", spec AS "규제특례사항_raw" FROM pre""",
    "special_law": rf"""WITH {DOCS}, {PRE} SELECT doc_id, {letters_only(r"regexp_replace(title, '^\s*[0-9]+(?:\s*[~\-–—]\s*[0-9]+)?\s*[.)\-:ㆍ·]?\s*', '')")} AS "특례법령",
      {letters_only('rel')} AS "관계법령", {letters_only('spec')} AS "규제특례사항" FROM pre""",
    "master_union": f"""
      WITH z AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
      SELECT c_custkey AS index, 'ICT' AS sandbox_type, c_mktsegment AS category, c_name AS title, '내용' AS main_content, NULL AS regulatory_issue,
        c_mktsegment AS regulatory_relief, '' AS conditions, '효과' AS expected_effect, c_name AS achievements, c_custkey AS ord, 1 AS src_no FROM customer
      UNION ALL SELECT rn, 'REG_ZONE', concat_ws(' / ', n_name, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END), s_name, n_name, '', '허용', '', '', '', s_suppkey, 2 FROM z
      UNION ALL SELECT row_number() OVER (ORDER BY p_partkey), 'FIN', p_brand, p_name, '', p_type, p_type, '', '', '', p_partkey, 3 FROM part
      UNION ALL SELECT n_nationkey, 'IND_LAW', '', n_name, '규제 ' || n_name, '규제 ' || n_name, '', '', '', '', n_nationkey, 4 FROM nation
      UNION ALL SELECT row_number() OVER (ORDER BY doc_id), 'IND_CASE', lang, source, text, '', '', '', '', '', doc_id, 5 FROM documents""",
    "strict_rename": """SELECT c_custkey AS index, 'ICT' AS sandbox_type, c_mktsegment AS category, c_name AS title, '내용' AS main_content,
      NULL AS regulatory_issue, c_mktsegment AS regulatory_relief, '' AS conditions, '효과' AS expected_effect, c_name AS achievements, c_custkey AS ord FROM customer""",
    "row_index": "SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS index FROM orders",
    "row_index_per_key": "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events",
    "composite_category": """SELECT s_suppkey AS pos, concat_ws(' / ', n_name, CASE WHEN s_suppkey % 3 <> 0 THEN s_name END) AS category,
      coalesce(n_name, 'nan') || ' / ' || coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_name END, 'nan') AS compat_category,
      n_name AS first_only, '' AS neither FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "first_present": "SELECT p_partkey AS pos, p_type AS issue, '' AS none, p_name AS title FROM part",
    "index_filter": """WITH r AS (SELECT o_orderkey, c_name, c_mktsegment, CASE WHEN o_orderstatus = 'P' THEN '미정' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date
        FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT * FROM r WHERE contains(lower(c_name || ' ' || c_mktsegment), 'auto') AND (date = '미정' OR date BETWEEN '1996-03-01' AND '1998-08-15')""",
    "index_counts": "SELECT event_type AS form_code, count(CASE WHEN value > 5 THEN user_id END) AS n_ids FROM events GROUP BY 1",
    "select_lookup": """SELECT user_id::VARCHAR AS "bdSeq", min(event_id) AS event_id, min_by(event_type, event_id) AS event_type, min_by(props, event_id) AS props
      FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "unmatched_ids": """WITH s AS (SELECT CASE WHEN s_suppkey % 7 = 0 THEN s_suppkey + 1000000000 ELSE s_suppkey END AS k FROM supplier)
      SELECT DISTINCT k::VARCHAR AS "bdSeq" FROM s WHERE k NOT IN (SELECT user_id FROM events)""",
    "selected_in_order": """SELECT user_id::VARCHAR AS "bdSeq", min(event_id) AS event_id, min_by(event_type, event_id) AS event_type,
      min_by(props, event_id) AS props, -user_id AS selected_pos
      FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "csv_roundtrip": "SELECT doc_id::VARCHAR AS doc_id, text, lang, source FROM documents",
    "jsonl_roundtrip": "SELECT doc_id, text, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang FROM documents",
    "distinct_ids": "SELECT DISTINCT l_suppkey::VARCHAR AS l_suppkey FROM lineitem",
    "detail_join": """WITH u AS (SELECT url, min_by(html, page_id) AS html FROM pages GROUP BY url)
      SELECT doc_id, p.url AS detail_url, length(u.html) AS n_html, CASE WHEN u.html IS NULL THEN 'empty' ELSE 'page' END AS src
      FROM documents LEFT JOIN pages p ON page_id = doc_id LEFT JOIN u ON u.url = p.url""",
    "missing_files": """SELECT doc_id, ' 법:령' || doc_id || '?' AS law_name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic <> 1 AND quality = 1)""",
    "have_missing": """SELECT count(*) AS n_total, count(l.doc_id) AS n_have, count(*) - count(l.doc_id) AS n_missing
      FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE toxic <> 1 AND quality <> 1) l USING (doc_id)""",
    "new_files": """SELECT '/d/법령' || doc_id || '.pdf' AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic <> 1 AND quality = 1)""",
    "latest_file": "SELECT event_id::VARCHAR AS path FROM events ORDER BY ts DESC, event_id::VARCHAR DESC LIMIT 1",
    "retry_outcomes": """SELECT ' 법:령' || d.doc_id || '?' AS key, CASE WHEN l.toxic = 1 THEN 'ok' ELSE 'failed' END AS status,
      CASE WHEN l.toxic = 1 THEN NULL ELSE 'file not found' END AS error
      FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.toxic = 1 OR l.quality <> 1""",
    "ingest_summary": """SELECT count(*) AS n_total, count(*) FILTER (l.toxic = 1) AS n_ok, count(*) FILTER (l.toxic IS NULL OR l.toxic <> 1) AS n_failed
      FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.toxic = 1 OR l.quality <> 1""",
    "law_files_roundtrip": "SELECT '법령 ' || doc_id || ' 100%' AS law_name, coalesce(text, '') AS text FROM documents",
    "csv_rejects": """WITH l AS (SELECT *, 2 + (doc_id % 7 <> 0)::INT + (doc_id % 5 = 0)::INT AS n, concat(doc_id, ',', lang,
        CASE WHEN doc_id % 7 = 0 THEN '' ELSE ',' || coalesce(source, '') END, CASE WHEN doc_id % 5 = 0 THEN ',x' ELSE '' END) AS line FROM documents)
      SELECT CASE WHEN n = 3 THEN doc_id::VARCHAR END AS doc_id, CASE WHEN n = 3 THEN nullif(lang, '') END AS lang,
        CASE WHEN n = 3 THEN CASE WHEN doc_id % 7 = 0 THEN 'x' ELSE nullif(source, '') END END AS source,
        CASE WHEN n <> 3 THEN line END AS line, CASE n WHEN 2 THEN 'too few cells' WHEN 4 THEN 'too many cells' END AS reason FROM l""",
    "page_stop_repeated": """WITH p AS (SELECT conv_id, turn, CASE WHEN length(text) % 17 = 0 THEN 0 ELSE length(text) END AS n_items, substr(text, 1, 1) AS shown
        FROM conversations WHERE turn <= 6),
      t AS (SELECT *, n_items = 0 OR coalesce(shown = lag(shown) OVER (PARTITION BY conv_id ORDER BY turn), false) AS ended FROM p)
      SELECT conv_id, turn, n_items, shown FROM t WHERE turn < ALL (SELECT turn FROM t e WHERE e.conv_id = t.conv_id AND e.ended)""",
    "page_stop": """WITH t AS (SELECT conv_id, turn, CASE WHEN length(text) % 5 = 0 THEN 0 ELSE length(text) END AS n_items FROM conversations WHERE turn <= 6)
      SELECT * FROM t WHERE turn < ALL (SELECT turn FROM t e WHERE e.conv_id = t.conv_id AND e.n_items = 0)""",
    "dedup_keep_first": "SELECT min(doc_id) AS doc_id, text, lang, min_by(source, doc_id) AS source, n_chars FROM documents GROUP BY text, lang, n_chars",
    "distinct_in_order": "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text",
    "first_n": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 25",
}
_CELLS = ", ".join(f"nullif({c}::VARCHAR, '') AS {c}" for c in C.COMMON_COLUMNS)
ORACLES["master_written_in_order"] = f"SELECT row_number() OVER (ORDER BY src_no, ord) AS pos, {_CELLS} FROM ({ORACLES['master_union']})"
