"""Markers, ladders and tables of the domain, as parameters of the operators."""

from __future__ import annotations

from dataclasses import dataclass

# The markers of the documents' sections, on folded text.
THEORY_START = r"^(?:phan )?[ab] ?[.\-–:)]? ?(?:kien thuc trong tam|ly thuyet|tom tat ly thuyet|tom tat kien thuc|phan li thuyet|phan ly thuyet)|^kien thuc trong tam\b"
THEORY_END = r"^(?:[ab] ?[.\-–:)]? ?)?(?:phan )?bai tap\b"

# Heading numerals in the order in which they are tried, then their rank in a document.
NUMBERING = (
    ("roman", r"^(X{0,2}(?:IX|IV|V?I{0,3}))\s*[.)\-–:]\s+(.*)$"),
    ("arabic", r"^([0-9]{1,2})\s*[.)\-–:]\s+(.*)$"),
    ("alpha_upper", r"^([A-Z])\s*[.)\-–:]\s+(.*)$"),
    ("alpha_lower", r"^([a-z])\s*[.)]\s+(.*)$"),
    ("star", r"^([*+❖])\s*(.*)$"),
    ("dash", r"^([—•])\s+(.*)$"),
)
LADDER = ("alpha_upper", "roman", "arabic", "alpha_lower", "star", "dash")

# What a title's beginning says of its section.
TITLE_KINDS = (
    ("dinh nghia", "definition"), ("dinh li", "theorem"), ("dinh ly", "theorem"), ("tinh chat", "property"), ("chu y", "note"), ("luu y", "note"),
    ("nhan xet", "remark"), ("vi du", "example"), ("ket luan", "summary"), ("quy uoc", "note"), ("he qua", "property"),
)
BOLD_TITLES = ("chu y", "luu y", "dinh ly", "dinh li", "dinh nghia", "tinh chat", "nhan xet")

# Subjects by a part of their folder's name.
SUBJECTS = (
    ("toan", "MATH", "Toán"), ("hoa", "CHEM", "Hóa học"), ("van", "LIT", "Ngữ văn"), ("dia", "GEO", "Địa lí"),
    ("gdktpl", "ECOL", "Giáo dục kinh tế và pháp luật"), ("su", "HIST", "Lịch sử"),
)

# Exercise markers, on text with accents.
QUESTION = r"(?iu)^câu\s*(\d+)\s*[.:)]?\s*"
LEVEL = r"^level ?([123])\b"
BLOOM = r"^(?:[ivx]+\.? ?)?(nhan biet|thong hieu|van dung cao|van dung)\b"
OPTION = r"(?<![a-zA-Z])[A-D][.)](?:\s|$)"
OPTION_MARK = r"^\s*([A-D])[.)]\s*"
BARE_LETTER = r"^\s*([A-D])[.)]?\s*$"
PUNCTUATION = r"^[.)\s]+$"
ANSWER_HEAD = r"(?iu)^\s*(?:=>|->|→)?\s*(?:đáp\s*án|lời\s*giải|chọn)(?![\p{L}\p{N}_])"
ANSWER = r"(?iu)^\s*(?:=>|->|→)?\s*đáp\s*án\s*[:.\-]?\s*([A-D](?:\s*(?:,|;|và)\s*[A-D])*)(?![\p{L}\p{N}_])\s*[.:)]?\s*"
SOLUTION = r"(?iu)^\s*lời\s*giải\s*$"
CHOSEN = r"(?iu)^\s*chọn\s+([A-D])(?![\p{L}\p{N}_])\s*[.:)]?\s*"

GAP = r"___|\[\.\.\.\]"
TRUE_FALSE = r"(?i)^\s*(?:<p>)?\s*[a-d1-4][.)]"

# Where a lesson's name, chapter and grade are found in a path or among the first paragraphs.
SUBJECT_FOLDER = r"(toan|hoa|van|dia|gdktpl|su)\s*\d"
GRADE = r"\b(1[0-2])\b"
LESSON = r"(?iu)b[àa]i\s*([0-9]{1,2})"
LESSON_PREFIX = r"(?iu)^.*?b[àa]i\s*[0-9]{1,2}\s*[.:\-–_)]*\s*"
READING = r"(?iu)^(?:v[aă]n b[ảa]n|đọc)\s*[0-9]*\s*[:.\-–]\s*"
CHAPTER = r"(?iu)^\s*chương(?![\p{L}\p{N}_])"

# The textbook that the documents follow.
BOOK, BOOK_NAME = "kntt", "Kết nối tri thức với cuộc sống"

# The other cropping mode's markers and headings, parts of folded lines or beginnings of plain ones.
CROP_START = r"kien thuc trong tam|ly thuyet|phan li thuyet"
CROP_END = r"^(?:b ?[.\-–:] ?|phan )?bai tap|b\. ?bai tap"
MAJOR = r"tong ket|ghi nho|doc van ban|kham pha van ban|ly thuyet"
CROP_HEADINGS = (
    ("H2", r"^\s*(?:[IVX]+|[A-Z])\s*[.\-–:]"), ("H3", r"^\s*(?:[0-9]+\.\s+|Hoạt động\s+[0-9]+|Câu hỏi\s+[0-9]+)"), ("H4", r"^\s*[a-z][).]\s+"), ("H5", r"^\s*\*.*:\s*$"),
)

# Labels and what they are written as.
LABELS = (
    ("van_dung_cao", ("van_dung_cao", "van dung cao"), ("application_high",), "application_high", 4),
    ("van_dung", ("van_dung", "van dung"), ("van", "application"), "application", 3),
    ("thong_hieu", ("thong_hieu", "thong hieu"), ("thong", "comprehension"), "comprehension", 2),
    ("nhan_biet", ("nhan_biet", "nhan biet"), ("nhan", "knowledge"), "knowledge", 1),
)
HEADING_LEVELS = (("nhan biet", "knowledge", 1), ("thong hieu", "comprehension", 2), ("van dung cao", "application", 4), ("van dung", "application", 3))


@dataclass(frozen=True)
class Gates:
    """Limits of the quality gates: (fail below or above, warn)."""

    words_fail: int = 50
    words_warn: int = 150
    figures_fail: int = 2
    resolved_fail: float = 0.70
    resolved_warn: float = 0.90
    coverage_fail: float = 0.80
    coverage_warn: float = 0.95
    inline_bytes_warn: int = 2_000_000
