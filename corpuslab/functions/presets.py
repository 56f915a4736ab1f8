"""Language presets for the transcript and sentence rules.

Every list and pattern below is data handed to the operators, never logic.
``HEBREW`` holds the values that must equal the reference's for identical
results; ``LATIN`` adapts the same rules to the Latin-script driver tables
(which contain no Hebrew and no speaker colons).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Preset:
    name: str
    # letters of the target script (one regex character class)
    script: str
    # whole words of this class are deleted from sentences (may be None)
    foreign_word: str | None
    # "protocol number" phrase; group 1 is a comma list of integers
    protocol_number: str
    # "session <ordinal words> of parliament" phrase; group 1 is the words
    session_ordinal: str | None
    ordinals: dict = field(default_factory=dict)
    exception_words: tuple = ()
    marked_files: tuple = ()
    bad_name_prefixes: tuple = ()
    title_patterns: tuple = ()
    removed_phrases: tuple = ()
    marked_removed_phrases: tuple = ()
    agenda_prefix: str | None = None
    plenary_code: str = "ptm"
    committee_code: str = "ptv"


# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

HEBREW_EXCEPTION_WORDS = (
    'משתתפים', 'מנהלות הוועדה', 'מנהל הוועדה', 'מוזמנים באמצעים מקוונים', 'משרד האוצר',
    'משתתפים באמצעים מקוונים', 'נכחו', 'מנהלת הוועדה', 'מסקנות הוועדה', 'משתתפים',
    'מוזמנים', 'סדר היום', 'חברי הוועדה', 'חברי הכנסת', 'ייעוץ משפטי',
    'מנהל/ת הוועדה', 'רצוני לשאול', 'קריאות', 'קריאה', 'האפשרות', 'ביום',
    'ברצוני לשאול', 'רישום פרלמנטרי', 'המשרד מתקצב חמש תכניות', 'נוכחים', 'משרד המשפטים', 'יועץ משפטי',
    'סדר-היום', 'רשמת פרלמנטרית', 'קצרנית', 'מנהלי הוועדה', 'חברי כנסת', 'רשמה וערכה',
)

HEBREW_MARKED_FILES = (
    '25_ptv_1219728.docx', '23_ptv_600338.docx', '25_ptv_1457545.docx', '25_ptv_3841247.docx', '23_ptv_599659.docx',
    '23_ptv_598723.docx', '23_ptv_598323.docx', '23_ptv_582824.docx', '20_ptv_519812.docx',
    '20_ptv_490139.docx', '20_ptv_488037.docx', '20_ptv_397418.docx', '20_ptv_387379.docx', '20_ptv_370910.docx',
    '20_ptv_341230.docx', '20_ptv_341020.docx', '20_ptv_320584.docx', '20_ptv_311936.docx', '19_ptv_266962.docx',
    '19_ptv_232326.docx', '19_ptv_302840.docx', '19_ptv_279660.docx', '19_ptv_262672.docx',
)

HEBREW_ORDINALS = {
    'החמש עשרה': 15, 'החמישים וארבע': 54, 'השלושים ושתיים': 32, 'הארבעים ושש': 46,
    'הארבעים ותשע': 49, 'השישים ותשע': 69, 'השישים ושלוש': 63, 'החמישים ושבע': 57, 'המאה ועשרים וארבע': 124,
    'המאה ושמונים וארבע': 184, 'המאה וחמישים ושש': 156, 'המאתיים ושמונים ושתיים': 282, 'המאתיים ושישים ותשע': 269,
    'המאה ושמונים וחמש': 185, 'המאתיים ושמונים': 280, 'השלוש מאות ושתיים': 302, 'השלוש מאות ושישים ושש': 366,
    'השלוש מאות ושמונים וארבע': 384, 'המאתיים ושישים ושבע': 267, 'המאה ושמונים ושלוש': 183,
    'הארבעים': 40, 'השמונים ותשע': 89, 'המאה וארבעים ואחת': 141, 'המאתיים ושישים ושתיים': 262, 'התשעים ושתיים': 92,
}

HEBREW_BAD_NAME_PREFIXES = ('ביום', 'אני', 'בפסקה', 'מר', 'משתתפים', 'האפשרות', 'קוראת', 'כרצוני לשאול')

# applied in this order (Python ``re`` syntax; ``\w`` means [\p{L}\p{N}_])
HEBREW_TITLE_PATTERNS = (
    r'\s*סגנית מזכיר הכנסת\s+', r'\s*סגן מזכיר הכנסת\s+', r'\s*סגן מזכירת הכנסת\s+',
    r'\s*סגנית מזכירת הכנסת\s+', r'\s*מזכיר הכנסת\s+', r'\s*מזכירת הכנסת\s+',
    r'\s*סגנית שר במשרד ראש הממשלה\s+', r'\s*סגן שר במשרד ראש הממשלה\s+',
    r'\s*השר לנושאים אסטרטגיים ולענייני מודיעין\s+', r'\s*(סגן|סגנית)\s+(ה\w+\s+וה\w+)\s*',
    r'\s*(סגן|סגנית)\s+(ה\w+\s+)\s*', r'\s*סגן\s+', r'\s*סגנית\s+', r'(?:שרת?\s+ה\w+,\s+ה\w+\s+וה\w+\s+).*',
    r'\s*שר(?:ת)?\s+ה\w+\s+וה\w+\s*', r'\s*שר(?:ת)?\s+ה\w+\s*', r'\s*השר(?:ה)?\s+ל\w+\s+\w+\s+',
    r'\s*שר(?:ת)?\s+ל\w+\s+[^,]\s', r'\s*סגן שר(?:ת)?(?:\s+[^,])?,', r'\s*שר(?:ת)?(?:\s+[^,])?,',
)

# applied in this order; the reference's list lacks two commas, which fuses
# 'היו”ר ' with 'השר' and 'היו"ר ' with 'ד"ר' (kept as written: ``compat``)
HEBREW_REMOVED_PHRASES_COMPAT = (
    '<< יור >>', '<< דובר >>', '(יש עתיד-תל"ם)', '<< אורח >>',
    '<< דובר_המשך >>', '<< קריאה >>', '<', '>', 'מ"מ היו"ר', 'היו"ר', 'היו”ר', 'היו”ר השר',
    'לביטחון פנים', 'ראש הממשלה', 'הלאומיות', 'פרופ',
    ' מר ', 'ופיתוח הכפר', 'תשובת', 'יו"ר', ' לאיכות הסביבה', 'עו"ד', 'נצ"מ', 'היו"ר ד"ר',
)

HEBREW_MARKED_REMOVED_PHRASES = (
    '<< יור >>', '<< דובר >>', '(יש עתיד-תל"ם)', '<< אורח >>',
    '<< דובר_המשך >>', '<< קריאה >>', '<', '>', 'היו"ר', 'שר הבינוי והשיכון ',
)

HEBREW = Preset(
    name="hebrew",
    script="[א-ת]",
    foreign_word="[a-zA-Z]+",
    protocol_number=r"פרוטוקול מס'\s*(\d+(?:,\s*\d+)*)",
    session_ordinal=r"הישיבה\s+(.*?)\s+של\s+הכנסת",
    ordinals=HEBREW_ORDINALS,
    exception_words=HEBREW_EXCEPTION_WORDS,
    marked_files=HEBREW_MARKED_FILES,
    bad_name_prefixes=HEBREW_BAD_NAME_PREFIXES,
    title_patterns=HEBREW_TITLE_PATTERNS,
    removed_phrases=HEBREW_REMOVED_PHRASES_COMPAT,
    marked_removed_phrases=HEBREW_MARKED_REMOVED_PHRASES,
    agenda_prefix="סדר[-\\s]היום",
)

# ---------------------------------------------------------------------------
# Latin preset for the driver tables (our choice, not the reference's):
# any letter is "target script", all-capital ASCII words are the "foreign"
# junk that gets deleted, the protocol number is the first integer list.
# ---------------------------------------------------------------------------

LATIN = Preset(
    name="latin",
    script=r"\p{L}",
    foreign_word="[A-Z]{2,}",
    protocol_number=r"(\d+(?:,\s*\d+)*)",
    session_ordinal=None,
    exception_words=("system", "agenda", "participants"),
    marked_files=(),
    bad_name_prefixes=("note", "page"),
    title_patterns=(r"\s*(?:mr|mrs|dr)\.?\s+",),
    removed_phrases=("<<", ">>", "<", ">"),
    marked_removed_phrases=("<<", ">>", "<", ">"),
    agenda_prefix="agenda",
)

PRESETS = {"hebrew": HEBREW, "latin": LATIN}
