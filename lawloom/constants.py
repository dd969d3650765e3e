"""Fixed values that results depend on: column lists, word lists, patterns."""

# --- fixed values: white space -------------------------------------------
# Code points that a Unicode-aware `\s` / `strip()` treats as white space.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The same set in a form that is quick to test: the regex engine keeps single characters below 256 in one table, but tries ranges in turn.
WS_QUICK = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
# A run that is not already one plain blank: single blanks, the common case, are never rewritten.
WS_RUN = rf"{WS_QUICK}(?:(?<=[^ ]){WS_QUICK}*+|{WS_QUICK}++)"
# Digits, Latin, Hangul syllables and jamo, in the same quick form; for use inside a class.
LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz가-힣ㄱ-ㅣ"
# All other characters. A negated class is slow to test, with a call for each single character, so what lies below 256 is listed.
NOT_LETTER = "[{}\\u0100-\\u3130\\u3164-\\uabff\\ud7a4-\\x{{10ffff}}]".format(
    "".join(f"\\x{i:02x}" for i in range(256) if not (chr(i).isascii() and chr(i).isalnum()))
)
NOT_WS = WS.replace("[", "[^", 1)
LINE_BREAK = r"[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029](?:(?<=\r)\n)?+"

# --- fixed values: common case schema ------------------------------------
COMMON_COLUMNS = [
    "index",
    "sandbox_type",
    "category",
    "title",
    "main_content",
    "regulatory_issue",
    "regulatory_relief",
    "conditions",
    "expected_effect",
    "achievements",
]

# --- fixed values: law rows ----------------------------------------------
LAW_ROW_COLUMNS = [
    "law_name",
    "chapter",
    "article_number",
    "article_title",
    "clause_number",
    "text",
]
LAW_HTML_COLUMNS = [
    "law_name",
    "section",
    "chapter",
    "article_number",
    "article_title",
    "clause_number",
    "text",
]
MAIN_SECTION = "본칙"
SUPPLEMENT_SECTION = "부칙"
FULL_TEXT_MARK = "전문"
OMITTED = "생략"
PUBLISHER_NAMES = ["국가법령정보센터", "법제처"]
ARTICLE_GAP_LIMIT = 5

CHAPTER_PATTERN = rf"^제{WS}*\p{{Nd}}+{WS}*장"
HTML_ARTICLE_PATTERN = rf"^(제\p{{Nd}}+조(?:의\p{{Nd}}+)?){WS}*(?:\(([^)]*)\))?"
CLAUSE_MARKS = "①-⑳"

# --- fixed values: list and detail pages ---------------------------------
FORMS = ("FORM_002", "FORM_003")
INDEX_COLUMNS = [
    "form_code",
    "bdSeq",
    "번호",
    "구분",
    "기업명",
    "서비스명",
    "designated_date",
    "detail_url",
    "list_td_text",
]
FIELDS = ["서비스 내용", "특례 내용", "부가조건", "규제", "기대효과", "개선결과"]
CASE_COLUMNS = ["번호", "구분", "기업명", "서비스명"] + FIELDS
META_COLUMNS = [
    "bdSeq",
    "form_code",
    "designated_date",
    "detail_url",
    "list_td_text",
    "extracted_columns",
] + ["src_" + f for f in FIELDS]
NOISE_TOKENS = ["작성일", "조회수", "첨부파일", "등록일", "다운로드", "파일"]

HEADER_FIELDS = {
    "서비스내용": "서비스 내용",
    "내용": "서비스 내용",
    "서비스개요": "서비스 내용",
    "개요": "서비스 내용",
    "사업개요": "서비스 내용",
    "사업내용": "서비스 내용",
    "신청내용": "서비스 내용",
    "제안내용": "서비스 내용",
    "특례내용": "특례 내용",
    "규제특례": "특례 내용",
    "부가조건": "부가조건",
    "조건": "부가조건",
    "조건사항": "부가조건",
    "규제": "규제",
    "관련규제": "규제",
    "규제내용": "규제",
    "규제현황": "규제",
    "현행규제": "규제",
    "기대효과": "기대효과",
    "기대되는효과": "기대효과",
    "정책효과": "기대효과",
    "파급효과": "기대효과",
    "개선결과": "개선결과",
    "개선효과": "개선결과",
    "개선사항": "개선결과",
}

FIELD_ALIASES = {
    "서비스 내용": ["서비스 내용", "내용", "사업내용", "서비스내용", "신청내용", "서비스 개요", "개요", "사업 개요", "제안내용"],
    "특례 내용": ["특례 내용", "특례내용", "규제특례", "규제 특례", "실증특례 내용", "실증 특례 내용", "특례"],
    "부가조건": ["부가조건", "부가 조건", "조건", "조건사항", "조건 사항", "부가 조건 사항"],
    "규제": ["규제", "관련 규제", "규제 내용", "규제내용", "규제현황", "현행 규제"],
    "기대효과": ["기대효과", "기대 효과", "효과", "기대되는 효과", "정책효과", "파급효과"],
    "개선결과": ["개선결과", "개선 결과", "개선사항", "개선 사항", "개선효과", "개선 효과"],
}

SEPARATOR_CHARS = " :：-–—·•\u00a0"

# --- fixed values: financial cases ---------------------------------------
FIN_FIELDS = ["서비스명", "지정 제도", "서비스 주요 내용", "규제 특례 내용", "주요 부가 조건 내용"]
FIN_LABELS = {
    "지정제도": "지정 제도",
    "지정제도구분": "지정 제도",
    "서비스명": "서비스명",
    "서비스주요내용": "서비스 주요 내용",
    "규제특례내용": "규제 특례 내용",
    "주요부가조건내용": "주요 부가 조건 내용",
}
FIN_ROW_NUMBERS = {
    "지정 제도": 1,
    "서비스명": 2,
    "서비스 주요 내용": 3,
    "규제 특례 내용": 5,
    "주요 부가 조건 내용": 6,
}
LIST_TABLE_WORDS = ["No", "NO", "no", "기업", "회사", "서비스", "상세", "보기", "등록일"]
SECTION_TABLE_WORDS = ["서비스", "지정", "규제", "부가", "내용"]
SECTION_ANCHOR = "샌드박스 지정 내용 및 성과"
DETAIL_HREF_TOKEN = "enterprise.do"
FIN_DETAIL_BASE = "https://sandbox.fintech.or.kr/business/enterprise.do?lang=ko&id="
FIN_DETAIL_LITERAL = r"https?://sandbox\.fintech\.or\.kr/business/enterprise\.do\?lang=ko&id=[0-9]+"
NULL_WORDS = ["", "-", "없음", "해당없음", "해당 없음", "미해당"]
NULL_WORD_PATTERN = rf"^(?:없음|해당없음|해당 없음|미해당)(?:\.|{WS})*\z"

# --- fixed values: list page of the selective collection -----------------
LIST_BASE = "https://www.sandbox.or.kr"
LIST_DETAIL_PATH = "/board/designated_case_edit.do"
LIST_TABLE_CLASSES = ["table_col", "no_active", "case"]

# --- fixed values: law site ----------------------------------------------
LAW_DETAIL_BASE = "https://www.law.go.kr/법령/"

# --- fixed values: free-zone cases ---------------------------------------
ZONE_COLUMNS = ["대제목", "중제목", "소제목", "현황", "허용"]
SPECIAL_LAW_COLUMNS = ["특례법령", "관계법령", "규제특례사항"]
HEADING_BULLETS = "ㅇo○●•∙·"
ROUND_PREFIX = rf"^{WS}*(?:\p{{Nd}}+|[①-⑳]){WS}*차{WS}*[-–—·.)]*{WS}*"
TRIAL_PREFIX = rf"^{WS}*[①-⑳]?{WS}*[(\[]?{WS}*실증{WS}*특례{WS}*[)\]]?{WS}*[-–—:·.)]*{WS}*"
STATUS_LABEL = rf"^{WS}*[(\[]?{WS}*(현황|허용|조건부{WS}*허용){WS}*[)\]]?{WS}*[:\-–—·.)]*{WS}*"
STATUS_PREFIX = rf"^{WS}*[(\[]?{WS}*현황{WS}*[)\]]?{WS}*[:\-–—·.)]*{WS}*"
ALLOW_PREFIX = rf"^{WS}*[(\[]?{WS}*(?:조건부{WS}*)?허용{WS}*[)\]]?{WS}*[:\-–—·.)]*{WS}*"
LEADING_INDEX = rf"^{WS}*\p{{Nd}}+(?:{WS}*[~\-–—]{WS}*\p{{Nd}}+)?{WS}*[.)\-:ㆍ·]?{WS}*"

# --- fixed values: text cleaning -----------------------------------------
ZERO_WIDTH = r"[\u200B-\u200F\u202A-\u202E\u2060-\u206F\uFEFF]"
GLYPHS = "•·●○◆◇■□▶▷◀◁▲△▼▽※☆★→←↔⇒⇔◦ㆍ❖➤➔➜➝✓✔✗✘"
LEADING_BULLETS = rf"(?:{WS}*(?:[\-–—•·/]|[①-⑳]|\(?\p{{Nd}}{{1,3}}\)?[.)]|[가-힣]\)){WS}*)"
LEADING_BULLETS_KEEP_DECIMALS = rf"(?:{WS}*(?:[\-–—•·/]|[①-⑳]|\(?\p{{Nd}}{{1,3}}\)?[.)](?!\p{{Nd}})|[가-힣]\)){WS}*)"
ILLEGAL_FILE_CHARS = '<>:"/\\|?*'
DEFAULT_LAW_NAME = "법령"
SENTENCE_LIMIT = 120

# Headers of the ICT table and the columns that they become.
ICT_COLUMNS = {
    "번호": "index",
    "구분": "category",
    "서비스명": "title",
    "서비스 내용": "main_content",
    "규제": "regulatory_issue",
    "특례 내용": "regulatory_relief",
    "부가조건": "conditions",
    "기대효과": "expected_effect",
    "개선결과": "achievements",
}
