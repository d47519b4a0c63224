"""Personal information inside free text: find it and replace it with typed placeholders.

An Aho-Corasick automaton finds anchors in one pass over each text: at-signs and their spelt forms,
schemes of telephone numbers and words that announce them, cues and shapes of identity numbers, words
of postal addresses, titles and phrases that introduce or follow a person. From each anchor a
deterministic local parser expands, to the left and right as far as the parts go, and validates what it
found: an address by the grammar of its local part and domain, a number by the plans of ``number_plan``,
a postal address by its parts, a name by its shape and what stands around it. Overlapping spans are
resolved by a fixed order of kinds. Nothing is looked up outside the record.

Defined results: null and empty texts hold nothing; spans are 0-based in characters, end exclusive;
a cue without a valid span beside it gives none; very long texts are read whole; repeated rows are
treated alike; extra columns are dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from lexquarry.llm.arrow import column, map_batches

KINDS = ("email", "id_number", "phone", "address", "name")
UP, LO = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"

# --- names -------------------------------------------------------------------------------------
_PART = rf"(?:De\s+[Ll]as?|De\s+[Ll]os|Del|Delos|Dela|Van|Von|San|Santa|DE\s+LAS?|DE\s+LOS|DEL|DELOS|DELA|VAN|VON|SAN|SANTA|de\s+la|de\s+los|del|de)"
_WORD = rf"(?!(?:De|Del|Delos|Dela|La|Las|Los|DE|DEL|DELOS|DELA|LA|LAS|LOS)\b)(?:[{UP}][{LO}]+(?:[-’'][{UP}][{LO}]+)*|[{UP}]{{2,}}(?:[-’'][{UP}]{{2,}})*)"
_SURNAME = rf"(?:{_PART}\s+)*{_WORD}"
_INITIAL = rf"[{UP}]\."
_SUFFIX = r"(?:,?\s+(?:Jr|Sr)\.|\s+(?:II|III|IV)\b)"
_GIVEN = rf"{_WORD}(?:\s+(?:{_WORD}|{_INITIAL}))*"
#: Surname, Given [M.] [Jr.]
INVERTED = rf"{_SURNAME}{_SUFFIX}?,\s+{_WORD}(?:\s+{_INITIAL}|\s+{_WORD}(?=[\s,.;(<)]))?{_SUFFIX}?"
#: Given [Middle or M.] Surname [Jr.]; also initials and a surname.
DIRECT = rf"(?:(?:{_WORD}|{_INITIAL})\s+){{1,3}}{_SURNAME}{_SUFFIX}?"
FULL = re.compile(rf"(?:{INVERTED}|{DIRECT})")
FULL_LINE = re.compile(rf"[ \t]*({INVERTED}|{DIRECT}|{_WORD})[ \t]*(?=\n|$)")
ANY = re.compile(rf"(?:{INVERTED}|{DIRECT}|{_SURNAME})")
INITIALS = re.compile(rf"(?:{_INITIAL}\s+)+{_SURNAME}")
#: Words in capitals that belong to no name.
NO_NAME = {
    "The", "A", "An", "Mr", "Ms", "Atty", "Street", "Philippines", "City", "No", "If", "While", "When", "Failure", "Nothing", "Every", "Any", "Each", "Upon", "May", "Under",
    "Annex", "Form", "Sheet", "Ledger", "Docket", "Sec", "Art", "Rule", "Order", "Republic", "Department", "Tel", "Email", "ID", "SSS", "TIN", "UMID", "GSIS", "CRN", "PhilHealth",
    "It", "For", "As", "At", "In", "Not", "On", "Ang", "Si", "Sa", "Ayon", "Inc", "Ltd", "Co", "Corp", "Trading", "Manufacturing",
    "He", "She", "They", "We", "You", "Who", "This", "That", "There", "These", "Those", "His", "Her", "Our", "Your", "Its", "My", "All", "Some", "Any", "One", "Both", "Either", "Nobody", "Please",
}
PRONOUNS = {"He", "She", "They", "We", "You", "Who", "It", "This", "That"}
TITLES = ["Mr.", "Mrs.", "Ms.", "Dr.", "Dra.", "Sr.", "Sra.", "Srta.", "Atty.", "Engr.", "Dir.", "Prof.", "Hon.", "Bb.", "Gng.", "Messrs.", " G. ", "\nG. ", " G.\n"]
BEFORE = [
    "Witness", "Complainant", "Contact:", "My name is", "According to", "The respondent,", "look for", "released to", "not to", "El testigo", "el testigo", "La testigo", "Enviar el pago a",
    "claim of", "投诉人", "申立人", "ผู้ร้องชื่อ", "शिकायतकर्ता", "المشتكي", "ay kay", "para kay", "ni kay", "whose name is", "Employee:", "Name:", "Attn:", "Dear",
]
#: Verbs whose agent or receiver is a person if the words after them look like a whole name.
BY = [f"{v} {p}" for v in ("signed", "prepared", "submitted", "filed", "approved", "reviewed", "witnessed", "certified", "noted", "written", "sworn", "represented", "drafted", "reported") for p in ("by",)] + ["c/o", "Cc:", "cc:", "addressed to", "care of"]
JOINED = re.compile(r"\s*(?:,\s*)?(?:and|y|at|&)\s+")
LINES = ["Prepared by:", "Respectfully,", "Respectfully yours,", "Sincerely,", "Very truly yours,", "Lubos na gumagalang,", "Atentamente,", "Noted by:", "Approved by:", "Signed:"]
AFTER = ["was hired as", "had moved to", "later wrote", "did not answer", "may be reached", "na nakatira sa", "said that her", "said that his", ", lives at", "lives at"]
NATIVE_TITLES = {"डॉ.": re.compile(r"\s*([ऀ-ॿ]+(?:\s+[ऀ-ॿ]+)?)\s+(?:ने|को|का|की|के|से|में|द्वारा)(?=\s)"), "د.": re.compile(r"\s*([؀-ۿ]+\s+[؀-ۿ]+)")}

# --- addresses -----------------------------------------------------------------------------------
STREET_NAMES = ["Street", "Road", "Avenue", "Boulevard", "Drive", "Lane", "Highway", "Court", "Circle", "Terrace", "St.", "Rd.", "Ave.", "Blvd.", "Ext.", "Dr.", "Ln.", "Hwy.", "Ct."]
_TOWN = rf"(?:[{UP}][{LO}]+|[{UP}]{{3,}})(?:[\s-]+(?!Tel\b|Email\b|E-mail\b)(?:[{UP}][{LO}]+|[{UP}]{{3,}}))*"
#: One to three towns; a further comma is followed by a town only if nothing else follows it there.
_TAIL = rf"(?:,\s+{_TOWN}){{1,3}}(?:,?\s+[A-Z]{{2}}\s+[0-9]{{5}}(?:-[0-9]{{4}})?|\s+[0-9]{{4,6}})?\b"
_STREET = rf"[{UP}][{LO}]+(?:\s+[{UP}][{LO}]+)*\s+(?:{'|'.join(re.escape(w) for w in STREET_NAMES)})"
ADDRESSES = [
    (["Rm. "], re.compile(rf"Rm\.\s+[0-9]+[A-Z]?,\s+[{UP}][{LO}]+(?:\s+[{UP}][{LO}]+)*\s+Bldg\.,\s+[0-9]+(?:-?[A-Z])?\s+{_STREET}{_TAIL}")),
    (["Unit "], re.compile(rf"Unit\s+[0-9]+[A-Z]?,\s+[0-9]+(?:-?[A-Z])?\s+{_STREET}{_TAIL}")),
    (["No. "], re.compile(rf"No\.\s+[0-9]+(?:-?[A-Z])?\s+{_STREET}{_TAIL}")),
    (["Purok "], re.compile(rf"Purok\s+[0-9]+,\s+(?:Brgy\.\s+{_TOWN}){_TAIL}")),
    (["P.O. Box", "P.O.\nBox"], re.compile(rf"P\.O\.\s+Box\s+[0-9]+{_TAIL}")),
    (["Blk ", "Blk. ", "Block "], re.compile(rf"(?:Blk\.?|Block)\s+[0-9]+[A-Z]?,?\s+Lot\s+[0-9]+[A-Z]?(?:,?\s+(?:Phase|Ph\.)\s+[0-9]+[A-Z]?)?,\s+{_TOWN}(?:\s+(?:Village|Subd\.|Subdivision|Homes|Heights|Estates|Townhomes))?{_TAIL}")),
    (["Calle "], re.compile(rf"Calle\s+{_TOWN}\s+[0-9]+,\s+[0-9]+\.º\s+[A-Z]{_TAIL}")),
    (["Avda. de"], re.compile(rf"Avda\.\s+de\s+{_TOWN},\s+n\.º\s+[0-9]+{_TAIL}")),
]
STREET_WORDS = [a + w for w in STREET_NAMES for a in " \n"]
#: Streets that carry their word at the end and the house number behind it, with the postal code before the town.
GERMANIC_WORDS = ["straße", "strasse", "weg ", "platz ", "allee ", "gasse ", "ufer ", "straat ", "laan "]
GERMANIC = re.compile(rf"(?:[{UP}][{LO}]+[ -])*[{UP}][{LO}]*(?:straße|strasse|str\.|weg|platz|allee|gasse|ufer|straat|laan)\s+[0-9]+\s?[a-z]?\b(?:,\s+[0-9]{{4,5}}\s+{_TOWN}|,\s+{_TOWN})?")
HOUSE = re.compile(rf"[0-9]+(?:-?[A-Z])?\s+{_STREET}(?:,\s+(?:(?:Brgy\.|Barangay)\s+)?{_TOWN}(?:\s+(?:Subd|Village)\.?)?)?{_TAIL}")
JAPANESE = re.compile(r"[一-鿿々]+[0-9０-９]+丁目[0-9０-９]+(?:[-−－‐][0-9０-９]+)*(?:番(?:地|[0-9０-９]+号)?)?")
CHINESE = re.compile(r"[一-鿿]{2,}?[省市县区镇乡村][一-鿿]*?[路街道巷][0-9０-９]+[号號](?:[0-9０-９]+[室楼层栋单元])*")

# --- numbers -------------------------------------------------------------------------------------
_S = r"[ \n]"
ID_CUES = [
    "SSS No.", "SSS no.", "SSS:", "TIN", "PhilHealth", "passport no.", "Passport No.", "national ID", "National ID", "member number", "ID #", "ID No.", "seaman's book", "seaman’s book", "UMID", "GSIS",
    "Pag-IBIG", "证件号码", "身份证", "旅券番号", "เลขหนังสือเดินทาง", "เลขประจำตัว", "पहचान क्रमांक", "ورقم جوازه", "رقم جواز", "رقم الهوية", "pasaporte", "cédula", "CRN-", "licencia", "license no.",
    "SSN", "Social Security", "social security number", "driver's license", "Driver's License", "Passport:", "passport number", "Passport Number", "Tax ID", "tax number", "Personalausweis", "Steuer-ID", "NIE", "DNI",
]
ID_VALUE = re.compile(rf"(?:CRN-)?[A-Z]{{0,3}}[0-9]{{2,}}(?:{_S}[0-9]{{2,}}|-[0-9]+)*[A-Z]?(?![0-9])")
ID_GAP = re.compile(r"(?:\s|:|：|#|ID|No\.|no\.|number|为|為|は|का|है|हैं|是|n\.º|núm\.|\.)*")
#: Shapes of identity numbers that need no cue, expanded from a hyphen or from a letter with a digit.
SHAPES = re.compile(r"(?:P[0-9]{7}[A-Z]|[0-9]{2}-[0-9]{7}-[0-9]|[0-9]{2}-[0-9]{9}-[0-9])(?![\w-])")
#: How telephone numbers begin, and words that announce one.
SCHEMES = ["+", "００", *[f"({d}" for d in "+0123456789"], *[f"0{d}" for d in range(10)], *[f"1{d}" for d in range(10)], "632", "０", "٠"]
PHONE_CUES = ["Call ", "call ", "Tel", "tel.", "tel:", "Phone", "phone", "Mobile", "mobile", "Cell", "cell", "Fax", "fax", "Text ", "text ", "WhatsApp", "Viber", "hotline", "Hotline"]
CUE_GAP = re.compile(r"(?:\s|:|\.|#|no\.|No\.|number|at|us|me|is|or)*")
NEXT_NUMBER = re.compile(r"\s*(?:or|and|/|,|;)\s*(?=[+(0-9])")
_GROUPED = r"[0-9]{1,5}(?:[ \n.-][0-9]{2,6}){1,4}"
_NUMBER = re.compile(
    rf"(?:\+[ \n]?|\(\+[0-9]{{1,3}}\)[ \n]?|00)?(?:\([0-9]{{1,5}}\)[ \n]?)?(?:0[0-9]{{3}}/[0-9]{{7}}|{_GROUPED}|[0-9]{{7,15}})"
    r"|[０-９]{2,4}[－−‐-][０-９]{2,4}[－−‐-][０-９]{4}|[٠-٩]{3}[ \n][٠-٩]{3}[ \n][٠-٩]{4}|[٠-٩]{10}", re.ASCII,
)
_GOES_ON = re.compile(r"[\w/-]*[0-9٠-٩０-９]", re.ASCII)


def number_plan(number: str, announced: bool) -> bool:
    """Whether a printed number fits a numbering plan; ``announced`` ones stand behind a word such as "Tel"."""
    if not number.isascii():
        return True
    groups = list(map(len, re.findall(r"[0-9]+", number)))
    digits, size = re.sub(r"[^0-9]", "", number), sum(groups)
    if number[0] == "+" or number.startswith("(+"):
        if digits.startswith("63"):
            return size == 12 and digits[2] == "9" and (groups[0] in (2, 5, 12))
        return 8 <= size <= 15 and digits[0] != "0" and len(groups) > 1
    if number.startswith("0063-"):
        return groups == [4, 3, 3, 4]
    if number[0] == "(":
        trunk = digits[0] == "0"
        return trunk and groups[0] in (2, 3) and groups[1:] in ([3, 4], [4, 4]) or not trunk and groups == [3, 3, 4] and digits[0] > "1" and digits[3] > "1"
    if digits.startswith("09") and size == 11:
        return groups in ([4, 3, 4], [4, 7], [11])
    if digits[0] == "0":
        return groups in ([3, 4, 4], [2, 4, 4], [4, 7]) and "-" in number or announced and 9 <= size <= 11
    if digits.startswith("632") and "." in number:
        return groups == [3, 4, 4]
    if digits[0] == "1" and groups == [11]:
        return True
    # Three, three and four digits, neither group below 200, are a number of the North American plan if announced.
    return announced and (groups == [3, 3, 4] and digits[0] > "1" and digits[3] > "1" or groups == [1, 3, 3, 4] and digits[0] == "1" or groups in ([3, 4], [4, 4]) and "-" in number)


CJK_PHONE = re.compile(r"(?:1[0-9]{10}|0[0-9]{3}-[0-9]{7,8}|0[0-9]{2}-[0-9]{4}-[0-9]{4}|[０-９]{3}[－−‐-][０-９]{4}[－−‐-][０-９]{4})(?![0-9０-９])")

# --- e-mail --------------------------------------------------------------------------------------
_LOCAL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*"
_DOT = r"(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?|\s+dot\s+|\s+DOT\s+)"
_DOMAIN = rf"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*{_DOT}[A-Za-z]{{2,}}"
DOMAIN = re.compile(_DOMAIN)
AT = {"@": re.compile(r"\s?@\s?"), "[at]": re.compile(r"\s?\[at\]\s?", re.I), "(at)": re.compile(r"\s?\(at\)\s?", re.I), " at ": re.compile(r"\s+at\s+", re.I)}
SPELT_DOMAIN = re.compile(r"[A-Za-z0-9][A-Za-z0-9-]*(?:(?:\s+dot\s+|\s?\[dot\]\s?|\s?\(dot\)\s?)[A-Za-z0-9][A-Za-z0-9-]*)+", re.I)


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, cues in (
        ("at", ["@", "[at]", "(at)", "[AT]", "(AT)"]), ("dot", [" dot ", "\ndot ", " dot\n", " DOT "]), ("title", TITLES), ("native", list(NATIVE_TITLES)), ("before", BEFORE), ("line", LINES),
        ("after", AFTER), ("id", ID_CUES), ("street", STREET_WORDS), ("ja", ["丁目"]), ("zh", ["寄至", "地址", "住址", "住在"]), ("zhphone", ["电话：", "连絡先は", "連絡先は", "電話番号は", "电话:"]), ("si", ["Si ", "si "]), ("by", BY), ("scheme", SCHEMES), ("call", PHONE_CUES), ("hyphen", ["-"]), ("letter", [f"P{d}" for d in range(10)]), ("germanic", GERMANIC_WORDS),
    ):
        for c in cues:
            a.add_word(c, (kind, c))
            if " " in c.strip():
                a.add_word(c.replace(" ", "\n"), (kind, c)) if c.count(" ") == 1 else None
    for i, (cues, _) in enumerate(ADDRESSES):
        for c in cues:
            a.add_word(c, (f"a{i}", c))
            if c.endswith(" "):
                a.add_word(c[:-1] + "\n", (f"a{i}", c))
    for cue in [c for c in (*BEFORE, *AFTER) if c.count(" ") > 1]:
        words = cue.split(" ")
        for k in range(1, len(words)):
            a.add_word(" ".join(words[:k]) + "\n" + " ".join(words[k:]), ("before" if cue in BEFORE else "after", cue))
    a.make_automaton()
    return a


_BLANK = re.compile(r"\s*")
_LAST_NAME = re.compile(rf"(?:{INVERTED}|{DIRECT}|{_SURNAME})$")
_RIGHT_LABEL = re.compile(r"(?:SSS No\.|TIN|PhilHealth ID|passport no\.|national ID|member number|ID #|seaman['’]s book)")


class Finder:
    """Finds the spans of one text after another."""

    def __init__(self):
        self.automaton = _automaton()

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end), ascending and free of overlaps."""
        if not text:
            return []
        found: list[tuple[str, int, int]] = []
        names: list[tuple[int, int]] = []
        for end, (kind, cue) in self.automaton.iter(text):
            end += 1
            start = end - len(cue)
            if kind == "at":
                self._email(text, start, cue.lower(), found)
            elif kind == "dot":
                self._spelt_email(text, start, found)
            elif kind == "id":
                self._id(text, start, end, cue, found, names)
            elif kind[0] == "a" and kind[1:].isdigit():
                if m := ADDRESSES[int(kind[1:])][1].match(text, start):
                    found.append(("address", m.start(), self._trim_address(text, m)))
            elif kind == "street":
                if (at := self._house(text, start)) >= 0 and (h := HOUSE.match(text, at)):
                    found.append(("address", h.start(), self._trim_address(text, h)))
                    self._resident(text, h.start(), names)
            elif kind == "germanic":
                a = start
                while a > 0 and (text[a - 1].isalpha() or text[a - 1] in " -" and text[a - 2 : a - 1].isalpha()):
                    a -= 1
                # The street may have several words; the first capital from which it parses counts.
                for x in (i for i in range(a, end) if text[i].isupper() and (i == a or not text[i - 1].isalpha())):
                    if m := GERMANIC.match(text, x):
                        found.append(("address", m.start(), self._trim_address(text, m)))
                        self._resident(text, m.start(), names)
                        break
            elif kind == "scheme":
                self._phone(text, start, False, found)
            elif kind == "call":
                at = CUE_GAP.match(text, end).end()
                while (stop := self._phone(text, at, True, found)) > 0 and (m := NEXT_NUMBER.match(text, stop)):
                    at = m.end()
            elif kind == "hyphen":
                if start > 1 and text[start - 2 : start].isdigit() and (start < 3 or not (text[start - 3].isalnum() or text[start - 3] in "_-")) and (m := SHAPES.match(text, start - 2)):
                    found.append(("id_number", m.start(), m.end()))
            elif kind == "letter":
                if (start == 0 or not (text[start - 1].isalnum() or text[start - 1] in "_-")) and (m := SHAPES.match(text, start)):
                    found.append(("id_number", m.start(), m.end()))
            elif kind == "ja":
                a = start
                while a > 0 and (text[a - 1].isdigit() or "一" <= text[a - 1] <= "鿿" or text[a - 1] == "々"):
                    a -= 1
                if m := JAPANESE.match(text, a):
                    found.append(("address", m.start(), m.end()))
            elif kind == "zh":
                if m := CHINESE.match(text, end):
                    found.append(("address", m.start(), m.end()))
            elif kind == "zhphone":
                if m := CJK_PHONE.match(text, end):
                    found.append(("phone", m.start(), m.end()))
            elif kind == "native":
                if (start == 0 or not text[start - 1].isalpha()) and (m := NATIVE_TITLES[cue].match(text, end)):
                    self._native(text, m, found)
            else:
                self._name(text, kind, cue, start, end, names)
        found += [("name", a, b) for a, b in names]
        return self._resolved(found)

    @staticmethod
    def _phone(text, at, announced, found) -> int:
        """Add the telephone number at ``at``; its end, or -1."""
        before = text[at - 1 : at]
        if before and (before.isascii() and before.isalnum() or before in "_+().,/-" or not announced and before in " \n" and text[at - 2 : at - 1].isdigit()):
            return -1
        m = _NUMBER.match(text, at)
        if not m:
            return -1
        end = m.end()
        while not number_plan(text[at:end], announced) or _GOES_ON.match(text, end):
            # Groups behind a blank may belong to what follows.
            cut = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
            if cut < 0:
                return -1
            end = cut
        found.append(("phone", at, end))
        return end

    @staticmethod
    def _house(text, start) -> int:
        """Where the house number before the words of a street begins: walk back over capitalised words."""
        a, words = start, 0
        while words < 5:
            b = a
            while a > 0 and not text[a - 1].isspace():
                a -= 1
            word = text[a:b]
            if word[:1].isdigit():
                return a if words else -1
            if not word[:1].isupper() or not word.isalpha():
                return -1
            words += 1
            while a > 0 and text[a - 1].isspace():
                a -= 1
        return -1

    def _resident(self, text, at, names):
        """A whole name before an address, at the beginning of its line."""
        line = text.rfind("\n", 0, at) + 1
        if (m := FULL.match(text, line)) and m.end() <= at and re.fullmatch(r",\s+", text[m.end() : at]) and self._plain_name(m.group()) and not any(w in m.group() for w in ("Inc", "Corp")):
            names.append((m.start(), m.end()))

    @staticmethod
    def _name_before(text, start) -> tuple[int, str]:
        """The stretch before ``start`` that looks like names: (its start, itself without blanks at the end)."""
        b = start
        while b > 0 and text[b - 1].isspace():
            b -= 1
        a = b
        while a > 0:
            x = a
            while x > 0 and not text[x - 1].isspace():
                x -= 1
            word = text[x:a]
            core = word.strip("(\"“‘")
            like = core[:1].isupper() or core in ("de", "la", "las", "los", "del", "respondent,", "although")
            if any(c in "@/0123456789" for c in core) or "\n\n" in text[a : a + 2]:
                break
            if not like or a < b and core[-1:] in ".!?;:" and len(core) > 2 and not core in ("Jr.", "Sr.", "Mr.", "Ms.", "Atty."):
                break
            a = x
            while a > 0 and text[a - 1].isspace():
                a -= 1
        while a < b and text[a].isspace():
            a += 1
        return a, text[a:b]

    # e-mail
    def _email(self, text, start, cue, found):
        a = start
        while a > 0 and text[a - 1].isspace() and start - a < 1:
            a -= 1
        m = AT[cue].match(text, a)
        if not m:
            return
        left = a
        while left > 0 and (text[left - 1].isascii() and text[left - 1].isalnum() or text[left - 1] in "._%+-"):
            left -= 1
        while left < a and not text[left].isalnum():
            left += 1
        local = text[left:a]
        spaced = m.group() != m.group().strip()
        domain = DOMAIN.match(text, m.end())
        if not local or not domain or spaced and cue == "@" and not any(c.isalpha() for c in local):
            return
        found.append(("email", left, domain.end()))

    def _spelt_email(self, text, start, found):
        """From " dot " back over the labels of the domain and " at " to the local part."""
        a, words = start, []
        while len(words) < 4:
            while a > 0 and text[a - 1].isspace():
                a -= 1
            b = a
            while a > 0 and (text[a - 1].isascii() and text[a - 1].isalnum() or text[a - 1] in "._%+-"):
                a -= 1
            if a == b:
                return
            words.append(a)
            if len(words) > 1 and text[a:b].lower() == "at":
                break
        else:
            return
        while a > 0 and text[a - 1].isspace():
            a -= 1
        b = a
        while a > 0 and (text[a - 1].isascii() and text[a - 1].isalnum() or text[a - 1] in "._%+-"):
            a -= 1
        while a < b and not text[a].isalnum():
            a += 1
        domain = SPELT_DOMAIN.match(text, words[-2])
        if a < b and domain and domain.end() > start:
            found.append(("email", a, domain.end()))

    # identity numbers
    def _id(self, text, start, end, cue, found, names):
        at = start if cue == "CRN-" else ID_GAP.match(text, end).end()
        m = ID_VALUE.match(text, at)
        if m and sum(c.isdigit() for c in m.group()) >= 7:
            found.append(("id_number", m.start(), m.end()))
            if cue != "CRN-" and (start < 1 or text[start - 1].isspace()) and (b := self._name_before(text, start))[1] and (n := _LAST_NAME.search(b[1])):
                a = b[0] + n.start()
                if " " in n.group() and self._plain_name(n.group()) and (a == 0 or text[a - 1] in "\n"):
                    names.append((a, a + len(n.group())))

    @staticmethod
    def _trim_address(text, m):
        """Drop from the end what a blank line separates."""
        cut = m.group().find("\n\n")
        return m.end() if cut < 0 else m.start() + cut

    def _native(self, text, m, found):
        words = m.group(1).split()
        stop = {"بذلك", "في", "من", "إلى", "على", "أن", "بأن"}
        keep = [w for w in words if w not in stop]
        if keep and (len(keep) == len(words) or words[: len(keep)] == keep):
            first = text.find(keep[0], m.start(1))
            last = text.find(keep[-1], first + (len(keep[0]) if len(keep) > 1 else 0)) if len(keep) > 1 else first
            found.append(("name", first, last + len(keep[-1])))

    # names
    @staticmethod
    def _plain_name(name: str) -> bool:
        words = re.findall(rf"[{UP}][{UP}{LO}]*", name)
        while name[1:2] == "." and len(words) > 1 and len(words[0]) == 1:
            words = words[1:]  # initials
        return bool(words) and words[0] not in (*NO_NAME, "El", "La", "Los", "Las") and not any(w in NO_NAME for w in words if len(w) > 1)

    @staticmethod
    def _cleaned(name: str) -> str:
        """Cut what cannot belong to the name: a blank line, or words that start the next sentence."""
        name = name.split("\n\n")[0]
        kept: list[str] = []
        for w in re.split(r"(\s+)", name):
            if w.strip(",.") in NO_NAME and kept and not re.fullmatch(rf"[{UP}]\.,?", w):
                break
            kept.append(w)
        name = "".join(kept).rstrip()
        return name if re.search(rf"(?:\b[{UP}]|Jr|Sr)\.$", name) else name.rstrip(",.")

    def _take(self, text, at, pattern, names) -> int:
        """Add the name at ``at``; its end, or -1."""
        m = pattern.match(text, at)
        if not m:
            return -1
        name = self._cleaned(m.group(m.lastindex or 0))
        a = m.start(m.lastindex or 0)
        if not name or not self._plain_name(name) or len(name) < 3:
            return -1
        names.append((a, a + len(name)))
        return a + len(name)

    def _name(self, text, kind, cue, start, end, names):
        at = _BLANK.match(text, end).end()
        if kind == "title":
            if start and text[start].isalpha() and text[start - 1].isalnum():
                return
            stop = self._take(text, at, ANY, names)
            if cue == "Messrs." and stop > 0 and (m := re.compile(r"\s+(?:and|y|at)\s+").match(text, stop)):
                self._take(text, m.end(), ANY, names)
        elif kind == "before":
            if start and text[start].isalpha() and text[start].isascii() and text[start - 1].isalnum():
                return
            if cue == "claim of":
                self._take(text, at, INITIALS, names)
            else:
                self._take(text, at, FULL, names)
        elif kind == "by":
            if start and text[start - 1].isalnum():
                return
            stop = self._take(text, at, FULL, names)
            while stop > 0 and (m := JOINED.match(text, stop)):
                stop = self._take(text, m.end(), FULL, names)
        elif kind == "line":
            self._take(text, at, FULL_LINE, names)
        elif kind == "si":
            if start and text[start - 1].isalpha():
                return
            if (m := FULL.match(text, at)) and re.compile(r"\s+(?:na\s+nakatira|ay\b)").match(text, at + len(self._cleaned(m.group()))):
                self._take(text, at, FULL, names)
        elif kind == "after":
            at, before = self._name_before(text, start)
            if m := _LAST_NAME.search(before):
                a = at + m.start()
                name = m.group()
                lead = re.match(rf"(?:(?:The|Complainant|Witness|Mr\.|Ms\.|Atty\.|Si|although|respondent,?)\s+)+", name)
                if lead:
                    a, name = a + lead.end(), name[lead.end() :]
                if self._plain_name(name) and name not in PRONOUNS and not re.search(r"(?:Inc|Ltd|Co|Corp)\.?,?$", before):
                    names.append((a, a + len(name)))

    @staticmethod
    def _resolved(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Without overlaps: kinds in their order, longer spans first."""
        starts: list[int] = []  # of the spans kept, ascending; their ends beside them
        ends: list[int] = []
        kept: list[tuple[str, int, int]] = []
        for kind, a, b in sorted(set(found), key=lambda f: (KINDS.index(f[0]), f[1] - f[2], f[1])):
            i = bisect_left(starts, b)
            if i == 0 or ends[i - 1] <= a:
                starts.insert(i, a)
                ends.insert(i, b)
                kept.append((kind, a, b))
        return sorted(kept, key=lambda f: f[1])


def personal_spans(df: DataFrame) -> DataFrame:
    """(doc_id, kind, start_pos, end_pos) of df (doc_id, text)."""
    made: dict[str, Finder] = {}

    def work(batch):
        finder = made.get("f") or made.setdefault("f", Finder())
        out = {"doc_id": [], "kind": [], "start_pos": [], "end_pos": []}
        for doc, text in zip(column(batch, "doc_id"), column(batch, "text")):
            for kind, a, b in finder.spans(text):
                for name, value in zip(out, (doc, kind, a, b)):
                    out[name].append(value)
        return out

    rows = df.where(F.col("text").isNotNull()).select("doc_id", "text")
    return map_batches(rows, work, "doc_id long, kind string, start_pos int, end_pos int")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by ``[KIND]``."""
    out, last = [], 0
    for kind, a, b in spans:
        out += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join(out) + text[last:]


def redacted(df: DataFrame) -> DataFrame:
    """(doc_id, text, n_spans) of df (doc_id, text), with placeholders in otherwise unchanged text."""
    made: dict[str, Finder] = {}

    def work(batch):
        finder = made.get("f") or made.setdefault("f", Finder())
        out = {"doc_id": [], "text": [], "n_spans": []}
        for doc, text in zip(column(batch, "doc_id"), column(batch, "text")):
            spans = finder.spans(text)
            for name, value in zip(out, (doc, redact(text, spans), len(spans))):
                out[name].append(value)
        return out

    rows = df.where(F.col("text").isNotNull()).select("doc_id", "text")
    return map_batches(rows, work, "doc_id long, text string, n_spans int")
