"""Personal information in free text: find it, and put placeholders or surrogates in its place.

Email addresses, phone numbers, identity numbers and street addresses are found by their shapes and labels. Persons are found by
what introduces them (titles, roles, set phrases, labels) and the grammar of names, by a common given name before a
capitalised surname, in Chinese by a label and a common surname, and by evidence of the document: a full name found once is found wherever
it stands in it. Longer and surer kinds go first and no two spans overlap.

`redacted` puts a typed placeholder in place of each, numbered per document so that one person keeps one number: a surname or
an initial with a surname is the one full name of the document that it fits, if there is just one.
`surrogates` generates keyed replacements instead: the same entity gets the same surrogate, of the same kind, gender, script
and format (capitals, initials, order, digit groups). The gender is that of the title, else of the given name, else what its
ending tells. Latin, Cyrillic and Greek names are made of syllables; in every other script each letter is replaced by another of the same
script and sort, and signs that belong to letters stay. A surrogate that another entity of the document has, or that stands in
its text, is drawn anew, so that distinct entities stay distinct. The key is a secret of the caller, given or in the session's
KEY_SETTING; where there is none, one is drawn for the call, so that no surrogate can be told from published code.

Defined results: null and empty texts have no mention and are returned as they are. Texts are read whole. Offsets count code
points. Repeated rows are treated each.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from re import _parser as sre

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("person", "email", "phone", "id_number", "address")
KEY_SETTING = "spark.litweave.surrogate.key"
SPANS = "doc_id bigint, kind string, start_char int, end_char int"

# Words of addresses, titles, roles and labels in the languages covered.
STREETS = "Street|St|Road|Rd|Lane|Ln|Close|Avenue|Ave|Drive|Dr|Boulevard|Blvd|Court|Ct|Way|Place|Pl|Square|Sq|Terrace|Crescent|Gardens|Grove|Row|Hill|Parkway|Pkwy|Highway|Circle"
GERMAN_STREETS = "straße|strasse|str\\.?|weg|gasse|platz|allee|ring|damm|ufer"
FRENCH_STREETS = "rue|avenue|impasse|boulevard|place|chemin|allée|quai|route|cours|passage|square"
SPANISH_STREETS = "Calle|C/|Avda\\.?|Avenida|Plaza|Pza\\.?|Paseo|Camino|Carrera|Ronda|Travesía"
TITLES = "Dr|Prof|Professor|Doctor|Mr|Mrs|Ms|Miss|Mx|Sir|Dame|Mme|Mlle|Madame|Monsieur|Frau|Herrn?|Sra|Sr|Srta|Señora|Señor|Dña|Doña|Don|Dra|Pr"
FEMALE_TITLES = "mrs ms miss dame mme mlle madame frau sra srta señora dña doña dra".split()
MALE_TITLES = "mr sir monsieur herr herrn sr señor don m d".split()
PARTICLES = "von der|von dem|von|van der|van den|van|de la|de las|de los|de|del|della|di|da|dos|du|des|le|la|al|el|bin|bint|ibn|ben|zu|zur|ter|ten|af|av"
ID_LABELS = (
    "social security (?:number|no\\.?)|SSN|driving licen[cs]e|driver'?s licen[cs]e|licen[cs]e (?:number|no\\.?)|passport|national ID|national insurance (?:number|no\\.?)|"
    "identity card|ID card|identity (?:number|no\\.?)|identification (?:number|no\\.?)|NHS (?:number|no\\.?)|MRN|medical record (?:number|no\\.?)|hospital (?:number|no\\.?)|patient (?:ID|number|no\\.?)|"
    "insurance (?:number|no\\.?)|tax (?:ID|number)|(?:residence|work) permit|Personalausweis|Ausweis(?:nummer|nr\\.?)|Reisepass(?:nummer)?|Versicherten(?:nummer|nr\\.?)|Versicherungs(?:nummer|nr\\.?)|"
    "Sozialversicherungs(?:nummer|nr\\.?)|Führerschein|Steuer-?ID|Patienten(?:nummer|nr\\.?|-ID)|carte d'identité|passeport|numéro de sécurité sociale|permis de conduire|NIR|"
    "DNI|NIE|pasaporte|número de la seguridad social|carné de conducir|身份证号?码?|护照号?码?|身分証番号|旅券番号|パスポート番号|マイナンバー"
)

# Vowel signs and other marks belong to the letter before them.
MARKS = "".join(chr(c) for c in range(0x300, 0x1100) if unicodedata.category(chr(c))[0] == "M")
CAP = r"[^\W\d_a-zß-öø-ÿ](?:[’'])?[^\W\d_]+(?:[’'][^\W\d_]+)?"
WORD = rf"(?:(?:[Ee]l|[Aa]l)-)?{CAP}(?:-{CAP})*"
SP = r"[^\S\r\n]*(?:\r?\n)?[^\S\r\n]*(?<=\s)"
INITIAL = r"[^\W\d_a-zß-öø-ÿ]\.(?:-?[^\W\d_a-zß-öø-ÿ]\.)*"
PART = rf"(?:(?:{PARTICLES}){SP})"
AFTER_TITLE = r"(?!(?:syndrome|disease|stain|test|method|fever|sign|score|reaction)\b)"
FULL = rf"(?:{WORD}|{INITIAL})(?:{SP}(?:{INITIAL}|{WORD})){{0,2}}?{SP}{PART}?{WORD}"
LAST_FIRST = rf"{PART}?{WORD},[^\S\r\n]*{SP}?(?:{WORD}(?:{SP}{INITIAL})?|{INITIAL}(?:{SP}{INITIAL})?)"
TITLE = rf"(?:\b(?:{TITLES})\b\.?{SP})"

TOWN = rf"(?:(?:New|Old|Great|Little|North|South|East|West|Upper|Lower|St\.?|Saint|San|Santa|Los|Las|Bad|Port|Fort)[ ])?{CAP}(?:-{CAP}|-(?:upon|on|sur|am|de|la|le|les|en)-{CAP})*(?:[ ](?:upon|on|sur|am|an der|de|del|la)[ ]{CAP})?"
GAP = r"(?:,?\s+|,\s*)"
UNIT = r"(?:Flat|Apt\.?|Apartment|Suite|Unit|Room|Rm\.?|Floor|Fl\.?)\s+\w{1,5}"
ENGLISH = (
    rf"(?:{UNIT}{GAP})?(?:{CAP}\s+(?:House|Cottage|Court|Lodge|Hall|Building|Villa){GAP})?\d{{1,5}}[A-Za-z]?(?:[-–/]\d{{1,4}})?,?\s+"
    rf"(?:(?:N|S|E|W|NE|NW|SE|SW)\.?\s+|(?:North|South|East|West)\s+)?(?:{CAP}\s+){{1,3}}?(?:{STREETS})\b\.?(?!-)(?:{GAP}{UNIT})?"
    rf"(?:{GAP}{TOWN})?(?:,?\s+(?:[A-Z]{{2}}\s+\d{{5}}(?:-\d{{4}})?|[A-Z]{{1,2}}\d[A-Z\d]?\s*\d[A-Z]{{2}}|\d{{5}})\b)?"
)
BOX = rf"(?:P\.?\s?O\.?\s+Box|PO\s+Box|Postfach|Apartado(?: de correos)?|B\.?P\.)\s+\d+(?:{GAP}{TOWN})?(?:,?\s+(?:[A-Z]{{2}}\s+)?\d{{4,5}}\b)?"
BOX_CODE_FIRST = rf"(?:Postfach|Apartado(?: de correos)?|B\.?P\.)\s+\d+{GAP}\d{{5}}\s+{TOWN}"
GERMAN = rf"{CAP}(?:{GERMAN_STREETS})\s+\d{{1,4}}[a-z]?(?:{GAP}\d{{5}}\s+{TOWN})?|{CAP}\s+(?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee)\s+\d{{1,4}}[a-z]?(?:{GAP}\d{{5}}\s+{TOWN})?"
FRENCH = rf"\d{{1,4}}(?:\s+(?:bis|ter|quater))?,?\s+(?:{FRENCH_STREETS})\s+(?:(?:de la|de l['’]|des|du|de|d['’])\s*)?{CAP}(?:[- ]{CAP})*(?:{GAP}\d{{5}}\s+{TOWN})?"
SPANISH = rf"(?:{SPANISH_STREETS})\s*(?:(?:de la|de los|de las|del|de)\s+)?{CAP}(?:\s+{CAP})*,?\s+(?:n\.?º\s*)?\d{{1,4}}(?:,\s+(?:bajo|ático|entresuelo|\d{{1,2}}\.?\s?[ºª°](?:\s+[A-Z]\b|\s+(?:izq|dcha)\.?)?))?(?:{GAP}\d{{5}}\s+{TOWN})?"
ADDRESS = re.compile(rf"(?<![\w.,-])(?:{BOX_CODE_FIRST}|{BOX}|{ENGLISH}|{FRENCH}|{GERMAN}|{SPANISH})")

DOMAIN_DOT = r"\s?[\(\[\{]\s?dot\s?[\)\]\}]\s?|\.|．"
AT = r"[@＠]|\s?[\(\[\{]\s?(?:at|AT|@)\s?[\)\]\}]\s?|\s[@＠]\s|\sAT\s"
EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?(?:{AT})[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:(?:{DOMAIN_DOT})[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
DOT_WORD = re.compile(r"\s?[\(\[\{]\s?(?:dot|at)\s?[\)\]\}]\s?", re.I)

EXT = r"(?:(?:,?\s*(?:ext\.?|extension|Durchwahl|Dw\.?|poste|int\.)|\s*x|\s*#)\s?\d{1,6})?"
PHONE = re.compile(
    r"(?<![A-Za-z0-9./+-])(?:"
    r"(?:\+|00(?=(?:\D?\d){9}))[1-9]\d{0,2}(?:[ \xa0.-]?\(\d{1,4}\))?(?:[ \xa0.-]?\d{1,8}){1,6}"
    r"|\(0?\d{2,4}\)[ \xa0.-]?\d{3,4}[ \xa0.-]?\d{3,4}"
    r"|\d{3}\.\d{3}\.\d{4}"
    r"|0\d(?:[ \xa0.]\d{2}){4}"
    r"|0\d{2}[ \xa0-]\d{4}[ \xa0-]?\d{4}|0\d{3,4}[ \xa0-]\d{3}[ \xa0-]?\d{3,4}|0\d{2,4}/\d{4,8}(?:-\d{1,4})?"
    r"|(?<=[ \xa0]o[ \xa0])[6-9]\d{2}[ \xa0]\d{3}[ \xa0]\d{3}"
    r")(?![\d/-])(?!\.\d)" + EXT,
)
PHONE_WORDS = "tel|phone|telephone|mobile|cell|fax|call|tél|telefon|teléfono|telefono|handy|número|number is"
PHONE_LABELS = "电话|電話|連絡先|手机|फ़ोन|هاتف|โทร"
PHONE_LABEL = re.compile(rf"(?:\b(?:{PHONE_WORDS})\b\.?|(?:{PHONE_LABELS})\.?)\s*[:：]?\s*(?:at|on)?\s*(\+?\(?\d[\d \xa0().-]{{5,18}}\d" + EXT + r")", re.I)
ID_VALUE = r"[A-Z]{0,6}\d[A-Z0-9]*(?:(?:[/.-]|[^\S\r\n])\d[A-Z0-9]*|[/-][A-Z0-9]+)*"
ID = re.compile(rf"(?<![A-Za-z0-9])(?i:{ID_LABELS})\s*(?:[:：#]|(?i:no\.?|number|is))?\s*({ID_VALUE})")
BARE_SSN = re.compile(r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![\w-])")

# Roles, phrases and labels that introduce a person.
ROLES = "Nurse|Patient(?:in)?|patiente?|paciente|Sister|Midwife|Surgeon|Physician|Consultant|Caretaker|Student|Volunteer|Participant|Herr|Frau"
PHRASES = (
    "my name is|name is|[Nn]ame\\s*[:：]|called|signed|[Rr]eviewed by|[Ww]ritten by|[Ee]dited by|[Aa]pproved by|[Ss]igned by|sent to|[Ww]e thank|[Tt]hanks to|[Cc]ontact|[Cc]orrespondence to|[Cc]orrespondence\\s*:|attn\\.?\\s*:?|"
    "guardian,|mother,|father,|relative,|carer,|[Aa]uthor contributions\\s*:|Corresponding author\\s*:|Correspondance\\s*:|Korrespondenz\\s*:|Correspondencia\\s*:|remercions|danken|Agradecemos a(?: la| el)?|Kontakt\\s*:|Contacto?\\s*:"
)
HAN_LABELS = "姓名|患者|病人|病患|氏名|联系人|聯絡人|医生|醫生|医師|先生|女士|护士"
LEADS = re.compile(rf"(?P<title>{TITLE}+)|(?:\b(?:{ROLES}){SP}|\b(?:{PHRASES}){SP}|(?:{HAN_LABELS})\s*[:：]?{SP})(?P<more>{TITLE}*)")
# Common Chinese surnames, and characters that follow a name without belonging to it.
HAN_SURNAMES = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文張劉陳楊趙黃吳孫馬羅鄭謝韓馮許鄧蕭葉蘇盧蔣賈鍾陸顧龍錢湯賀賴龔"
HAN_AFTER = "因的在于是说和与及为以被从到对向就于已曾将来去有无之同等也还先女男医护住报主自患，。、；：）,.;:)"
HAN_NAME = re.compile(rf"(?:{HAN_LABELS})\s*[:：]?\s*(?P<name>(?:欧阳|司马|上官|诸葛|[{HAN_SURNAMES}])(?:[\u4e00-\u9fff](?=[{HAN_AFTER}\s]|$)|[\u4e00-\u9fff]{{2}}))")
# Common given names.
FEMALE_NAMES = set(
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Betty Margaret Sandra Ashley Emily Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia Amy Kathleen Angela Anna Emma Maria Julia Sophie Alice Ruth Helen Rachel Catherine Christine "
    "Claire Camille Chloé Élise Hélène Isabelle Nathalie Sylvie Ursula Ingrid Heike Sabine Katrin Carmen Lucía Pilar Ana Rosa Olga Irina Natalia Tatiana Svetlana Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Μαρία Ελένη Κατερίνα".split()
)
MALE_NAMES = set(
    "James Robert John Michael David William Richard Joseph Thomas Christopher Charles Daniel Matthew Anthony Steven Paul Andrew Joshua Kenneth Kevin Brian George Timothy Ronald Edward Jason Jeffrey Ryan Jacob Nicholas Eric Jonathan Stephen Peter Henry Walter Luca Joshua Noah Nikita "
    "Pierre Jean Jacques Michel François Olivier Hans Klaus Jürgen Wolfgang Stefan Carlos José Luis Miguel Javier Ivan Sergei Dmitri Vladimir Алексей Александр Сергей Дмитрий Иван Никита Илья Владимир Николай Γιώργος Νίκος Δημήτρης".split()
)
GIVEN = re.compile(rf"(?<![\w-])(?:{'|'.join(sorted(FEMALE_NAMES | MALE_NAMES))})(?:{SP}{INITIAL})?{SP}{PART}?{WORD}")
THING_AFTER = re.compile(r"(?:['’]s)?[^\S\r\n]+(?:syndrome|disease|stain|test|method|fever|sign|score|reaction|University|Hospital|Institute|Street|Road|College|Foundation|Center|Centre)\b")
# A title of one letter is told from an initial by what follows: a given name, a surname with one, or two initials.
AFTER_LETTER = rf"(?={LAST_FIRST}|{WORD}{SP}(?:{PART}?{WORD}|{INITIAL})|{INITIAL}{SP}{INITIAL})"
FRENCH_M = re.compile(rf"M\.{SP}{AFTER_LETTER}")
SPANISH_D = re.compile(rf"D\.{SP}{AFTER_LETTER}")
AND = re.compile(rf"(?:,?{SP}(?:and|und|et|y|&){SP}|,{SP})(?P<more>{TITLE}*)")
NAME = re.compile(rf"(?:{LAST_FIRST}|{FULL})")
SURNAME = re.compile(rf"{PART}?{WORD}{AFTER_TITLE}")
TITLES_RE = re.compile(TITLE)
# Words in capitals that follow a role without being a name.
NO_NAME = set("ID No Number MRN NHS SSN PhD The This These We In On At For With And Or From All Each No Data Samples Group Groups".split())


def literals(pattern: str) -> set[str]:
    """The literal beginnings, in small letters, of all that a label pattern matches: what has to be in a text for it to match."""

    def spelled(items: Iterable) -> list[tuple[str, bool]]:
        out = [("", True)]  # each with whether it may go on
        for kind, what in items:
            if kind is sre.LITERAL:
                ends = [(chr(what), True)]
            elif kind is sre.IN and all(k is sre.LITERAL for k, _ in what):
                ends = [(chr(c), True) for _, c in what]
            elif kind is sre.SUBPATTERN:
                ends = spelled(what[3])
            elif kind is sre.BRANCH:
                ends = [e for branch in what[1] for e in spelled(branch)]
            elif kind is sre.MAX_REPEAT and what[:2] == (0, 1):
                ends = [("", True), *spelled(what[2])]
            else:
                ends = [("", False)]
            out = [x for x in out if not x[1]] + [(a + b, on) for a, going in out if going for b, on in ends]
        return out

    return {t.lower().rstrip() for t, _ in spelled(sre.parse(pattern))}


@lru_cache(maxsize=1)
def pieces():
    """One automaton for the beginnings of all labels and introductions: a single scan tells which patterns can match, and where."""
    import ahocorasick

    known: dict[str, set[str]] = {}
    lists = (("id", ID_LABELS), ("phone", f"{PHONE_WORDS}|{PHONE_LABELS}"), ("lead", f"{TITLES}|{ROLES}|{PHRASES}"), ("han", HAN_LABELS), ("given", "|".join(sorted(FEMALE_NAMES | MALE_NAMES))))
    for kind, pattern in lists:
        for w in literals(pattern):
            known.setdefault(w, set()).add(kind)
    automaton = ahocorasick.Automaton()
    for w, kinds in known.items():
        automaton.add_word(w, (len(w), kinds))
    automaton.make_automaton()
    return automaton


def scan(text: str) -> tuple[set[str], list[int]]:
    """The kinds of pieces that the text has, and where introductions can begin."""
    low = text.lower()
    if len(low) != len(text):  # a few letters change their length
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    kinds: set[str] = set()
    starts: set[int] = set()
    for end, (n, k) in pieces().iter(low):
        kinds |= k
        if "lead" in k:
            starts.add(end - n + 1)
    return kinds, sorted(starts)


def is_name(words: str) -> bool:
    ws = re.findall(r"[^\W\d_]+", words)
    return bool(ws) and not any(w in NO_NAME for w in ws) and max(map(len, ws)) > 1


def name_at(text: str, at: int, taken: list[bool], single: bool) -> tuple[int, int] | None:
    """The span of the name that begins here, if one does."""
    m = NAME.match(text, at)
    if m is not None:
        end = m.end()
        comma = text.find(",", at, end)
        if comma >= 0:
            after = text[end : end + 30]
            house = re.match(r"\s+(?:House|Cottage|Lodge|Hall|Street|Road|Lane|Court|\d)", after)
            if any(taken[comma:end]) or house or not is_name(text[comma:end]):
                m2 = re.compile(FULL).match(text, at, comma)
                end = m2.end() if m2 else comma if single else at
                if end < comma and m2:
                    end = m2.end()
        if end > at and not any(taken[at:end]) and is_name(text[at:end]):
            return at, longest(text, at, end, taken)
    if single and (m := SURNAME.match(text, at)) and not any(taken[at : m.end()]) and is_name(m.group()):
        if not re.match(r"(?:'s)?\s+(?:syndrome|disease|stain|test|method|fever|sign|score|reaction)\b", text[m.end() : m.end() + 20]):
            return at, m.end()
    return None


MORE = re.compile(rf"[^\S\r\n]+{PART}?{WORD}(?=[^\S\r\n]*(?:[,.;:()]|\r?\n|$|[^\S\r\n]+(?:[a-z(]|et\b|und\b|y\b)))")


def longest(text: str, at: int, end: int, taken: list[bool]) -> int:
    """Names of three or four words: the grammar takes the fewest; further capitalised words on the line belong to it."""
    if "," in text[at:end]:
        return end
    while (m := MORE.match(text, end)) and not any(taken[end : m.end()]) and is_name(m.group()):
        end = m.end()
    return end


def mentions(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all mentions, in order, without overlap."""
    if not text:
        return []
    out: list[tuple[int, int, str]] = []
    taken = [False] * len(text)

    def take(a: int, b: int, kind: str) -> None:
        while b > a and (text[b - 1].isspace() or text[b - 1] in ",;:"):
            b -= 1
        if b > a and not any(taken[a:b]):
            out.append((a, b, kind))
            taken[a:b] = [True] * (b - a)

    digits = any(c.isdigit() for c in text)
    if "@" in text or "＠" in text or DOT_WORD.search(text) or " AT " in text:
        for m in EMAIL.finditer(text):
            take(m.start(), m.end(), "email")
    kinds, starts = scan(text)
    if digits:
        for m in ID.finditer(text) if "id" in kinds else ():
            if sum(c.isdigit() for c in m[1]) >= 4:
                take(m.start(1), m.end(1), "id_number")
        for m in BARE_SSN.finditer(text):
            take(m.start(), m.end(), "id_number")
        for m in ADDRESS.finditer(text):
            take(m.start(), m.end(), "address")
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in re.sub(EXT + "$", "", m.group())) <= 15:
                take(m.start(), m.end(), "phone")
        for m in PHONE_LABEL.finditer(text) if "phone" in kinds else ():
            if 7 <= sum(c.isdigit() for c in m[1]) <= 15 and not any(taken[m.start(1) : m.end(1)]):
                take(m.start(1), m.end(1), "phone")
    full: dict[str, None] = {}
    last = 0
    for begin in starts:
        if begin < last or (m := LEADS.match(text, begin)) is None:
            continue
        at = last = m.end()
        lead = m.group()
        single = bool(m.group("title") or m.group("more"))
        if not single and re.match(r"(?:Correspondance|remercions|Nous)", lead) and (t := FRENCH_M.match(text, at)):
            at, single = t.end(), True
        elif not single and re.match(r"(?:Correspondencia|Agradecemos)", lead) and (t := SPANISH_D.match(text, at)):
            at, single = t.end(), True
        got = name_at(text, at, taken, single)
        while got:
            take(*got, "person")
            if len(re.findall(r"\w+", text[slice(*got)])) > 1:
                full.setdefault(text[slice(*got)])
            a = AND.match(text, got[1])
            if not a or "," in a.group() and not a.group("more"):
                break
            got = name_at(text, a.end(), taken, bool(a.group("more")))
    for m in HAN_NAME.finditer(text) if "han" in kinds else ():
        take(*m.span("name"), "person")
        full.setdefault(m["name"])
    for m in GIVEN.finditer(text) if "given" in kinds else ():
        if not any(taken[m.start() : m.end()]) and is_name(m.group()) and not THING_AFTER.match(text, m.end()):
            take(*m.span(), "person")
            full.setdefault(m.group())
    for name in full:
        # The same full name elsewhere in the document.
        edge = "" if "\u4e00" <= name[0] <= "\u9fff" else r"\w"  # between Han characters no word ends
        for m in re.finditer(rf"(?<!{edge}){re.escape(name)}(?!{edge})" if edge else re.escape(name), text):
            take(m.start(), m.end(), "person")
    return sorted(out)


def found(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kind, start_char, end_char), one row per mention."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, k, a, z) for i, t in zip(b.iloc[:, 0], b.iloc[:, 1]) for a, z, k in mentions(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "start_char", "end_char"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text).where(F.length(text) > 0).mapInPandas(each, SPANS)


def name_words(mention: str) -> list[str]:
    """The words of a name in small letters, the surname last."""
    t = unicodedata.normalize("NFKC", mention).casefold()
    if "," in t:
        last, _, first = t.partition(",")
        t = f"{first.strip()} {last.strip()}"
    return re.findall(r"[\w'-]+", t)


def entity_of(kind: str, text: str) -> str:
    """What two mentions of one entity have in common."""
    if kind == "person":
        return " ".join(name_words(text))
    t = unicodedata.normalize("NFKC", text).casefold()
    if kind == "email":
        t = re.sub(r"\s?[\(\[\{]?\s?\bat\b\s?[\)\]\}]?\s?", "@", re.sub(r"\s?[\(\[\{]\s?dot\s?[\)\]\}]\s?", ".", t))
        return re.sub(r"\s", "", t)
    return re.sub(r"[^\w]", "", t)


def entities_of(said: list[tuple[str, str]]) -> list[str]:
    """The entity of each (kind, mention) of a document: a surname, alone or with initials, is the one full name that it fits, if just one does."""
    full: dict[str, set[tuple[str, ...]]] = {}
    for kind, mention in said:
        ws = name_words(mention) if kind == "person" else []
        if len(ws) > 1 and len(ws[0]) > 1:
            full.setdefault(ws[-1], set()).add(tuple(ws))
    out = []
    for kind, mention in said:
        entity = entity_of(kind, mention)
        if kind == "person":
            ws = name_words(mention)
            if ws and all(len(w) == 1 for w in ws[:-1]):
                fits = [n for n in full.get(ws[-1], ()) if all(w == v[0] for w, v in zip(ws[:-1], n))]
                entity = " ".join(fits[0]) if len(fits) == 1 else entity
        out.append(entity)
    return out


def gender_of(mention: str, title: str) -> bool | None:
    """Whether the name is a woman's: by the title, else by the given name; None where neither tells."""
    low = title.lower().strip(" .")
    if low in FEMALE_TITLES or low in MALE_TITLES:
        return low in FEMALE_TITLES
    given = (mention.partition(",")[2].strip() or mention).split()
    first = given[0].capitalize() if given else ""
    return True if first in FEMALE_NAMES else False if first in MALE_NAMES else None


def ends_female(mention: str) -> bool:
    """What the ending of the given name, or of a Russian surname, tells."""
    given = (mention.partition(",")[2].strip() or mention).split()
    return bool(given) and (given[0].casefold().endswith(("a", "а", "я", "η", "α", "ा", "ी")) or mention.casefold().rstrip().endswith(("ова", "ева", "ина", "ая")))


class Surrogates:
    """Keyed replacements within one document."""

    # Syllables of invented names.
    ONSETS = "b br d dr f fl g gr h j k kl l m n p pl r s st t tr v w z".split()
    VOWELS = "a e i o u ia ei au".split()
    CODAS = "l n r s m nd rt lk st".split()
    # The same sounds in other scripts, and the letters that stand for letters; by the first word of the letters' Unicode names.
    SOUNDS = {
        "CYRILLIC": str.maketrans(dict(zip("abdefghijklmnoprstuvwz", "абдефгхийклмнопрстувшз"))),
        "GREEK": str.maketrans(dict(zip("abdefghijklmnoprstuvwz", "αβδεφγχιξκλμνοπρστυθψζ"))),
    }
    # Endings of a woman's and a man's given name, and of their surnames.
    ENDINGS = {"CYRILLIC": ("а", "ан", "ова", "ов"), "GREEK": ("α", "ος", "ου", "ης")}
    # The common letters of other scripts, by code point, and characters of Chinese given names.
    RANGES = {"ARABIC": (0x627, 0x64A), "HEBREW": (0x5D0, 0x5EA), "DEVANAGARI": (0x915, 0x939), "THAI": (0xE01, 0xE2E), "HANGUL": (0xAC00, 0xD7A3), "HIRAGANA": (0x304B, 0x3093), "KATAKANA": (0x30AB, 0x30F3), "ARMENIAN": (0x561, 0x586), "GEORGIAN": (0x10D0, 0x10F0), "BENGALI": (0x995, 0x9B9)}
    HAN_FEMALE, HAN_MALE = "芳娜敏静丽艳娟霞秀英玉兰燕玲桂梅琴珍雪蓉", "伟强磊军洋勇杰涛明超刚平辉鹏飞斌宇浩凯健"
    LETTERS = {"CYRILLIC": ("аеиоу", "бвгдзклмнпрст"), "GREEK": ("αεηιο", "βγδζθκλμνπρτφ")}

    def __init__(self, key: str, text: str):
        self.key, self.text = key.encode(), text
        self.given: dict[tuple[str, str], str] = {}
        self.female: dict[str, bool] = {}

    def draw(self, *what: object) -> int:
        return int.from_bytes(hmac.new(self.key, "\x1f".join(map(str, what)).encode(), hashlib.sha256).digest()[:12], "big")

    @staticmethod
    def script(text: str) -> str:
        return next((unicodedata.name(c, "").partition(" ")[0] for c in text if c.isalpha()), "")

    def accented(self, like: str, made: str) -> str:
        """`made` with the marks of `like`, each on a letter of the same kind, if one is there."""
        for c in unicodedata.normalize("NFC", like.casefold()):
            plain, *marks = unicodedata.normalize("NFD", c)
            if marks and plain.isalpha():
                kind = plain in "aeiouаеиоуαεηιουω"
                fits = [i for i, m in enumerate(made) if i and len(unicodedata.normalize("NFC", m + "".join(marks))) == 1 and (m in "aeiouаеиоуαεηιουω") == kind]
                if fits:
                    made = made[: fits[0]] + unicodedata.normalize("NFC", made[fits[0]] + "".join(marks)) + made[fits[0] + 1 :]
        return made

    def word(self, seed: int, last: bool, female: bool, like: str) -> str:
        """An invented name in the script of `like`, with its accents."""
        script = self.script(like)
        if script not in ("LATIN", "", *self.SOUNDS):
            return "".join(self.letter(c, *divmod(seed >> 5 * i, 31)[::-1], i == 0 and last, female) for i, c in enumerate(like))
        out = ""
        for _ in range(2):
            out += self.ONSETS[seed % len(self.ONSETS)]
            seed //= len(self.ONSETS)
            out += self.VOWELS[seed % len(self.VOWELS)]
            seed //= len(self.VOWELS)
        out = (out + self.CODAS[seed % len(self.CODAS)]).translate(self.SOUNDS.get(script, {}))
        given_f, given_m, last_f, last_m = self.ENDINGS.get(script, ("a", "o", "er", "er"))
        out += (last_f if female else last_m) if last else given_f if female else given_m
        return self.accented(like, out).capitalize()

    def letter(self, c: str, low: int, high: int, surname: bool = False, female: bool = False) -> str:
        """Another letter of the same script and sort; signs and anything else stay."""
        if unicodedata.category(c)[0] != "L":
            return c
        if "\u4e00" <= c <= "\u9fff":
            pool = HAN_SURNAMES if surname else self.HAN_FEMALE if female else self.HAN_MALE
        else:
            script = self.script(c)
            begin, end = self.RANGES.get(script, (ord(c) & ~63, ord(c) | 63))
            pool = [x for x in map(chr, range(begin, end + 1)) if unicodedata.category(x) == unicodedata.category(c) and unicodedata.name(x, "").startswith(script)]
        pool = [x for x in pool if x != c]
        return pool[(low + 31 * high) % len(pool)] if pool else c

    def replace(self, kind: str, mention: str, title: str = "", entity: str | None = None, female: bool | None = None) -> str:
        entity = entity or entity_of(kind, mention)
        told = gender_of(mention, title) if female is None else female
        woman = self.female.setdefault(entity, ends_female(mention) if told is None else told)  # as at the first mention
        for turn in range(1000):
            made = self.person(mention, woman, turn) if kind == "person" else self.shaped(kind, mention, entity, turn)
            holder = self.given.get((kind, made.casefold()))
            if holder == entity or holder is None and made not in self.text:
                self.given[kind, made.casefold()] = entity
                return made
        raise ValueError("no distinct surrogate could be drawn")

    def person(self, mention: str, female: bool, turn: int) -> str:
        """Each word of the name by its own key, so a shared surname stays shared; initials follow the new words."""
        particles = set(PARTICLES.replace("|", " ").split())

        def new(m: re.Match) -> str:
            w = m.group()
            if w.casefold() in particles and w.islower():
                return w
            han = "\u4e00" <= w[0] <= "\u9fff"
            last = han or (m.end() == len(mention) if "," not in mention else m.end() <= mention.index(","))
            made = self.word(self.draw("name", w.casefold(), female and (han or not last), turn), last, female, w)
            return made[0] if len(w) == 1 else made.upper() if w.isupper() else made.lower() if w.islower() else made

        return re.sub(rf"(?:[^\W\d_][{MARKS}]*)+", new, mention)

    def shaped(self, kind: str, mention: str, entity: str, turn: int) -> str:
        """The same shape: digits for digits, letters of the same case for letters; set words, country codes and endings stay."""
        keep = re.compile(
            r"^(?:\+|00)\d{1,3}|(?:ext\.?|x)\s?(?=\d)" if kind == "phone" else
            r"@|＠|\s?[\(\[\{]?\s?\b(?:at|AT|dot)\b\s?[\)\]\}]?\s?|\.[A-Za-z]+$" if kind == "email" else
            rf"\b(?:{STREETS}|Flat|Apt|Suite|House|P\.?\s?O\.?\s+Box|{FRENCH_STREETS}|bis|du|des|de la|de|Calle|C/|Avda|bajo)\b|(?:{GERMAN_STREETS})(?=\s\d)" if kind == "address" else
            r"(?!)"
        )
        kept = [m.span() for m in keep.finditer(mention)]
        seed = self.draw(kind, entity, turn)
        out = []
        for i, c in enumerate(mention):
            if not c.isalnum() or any(a <= i < b for a, b in kept):
                out.append(c)
                continue
            seed, k = divmod(seed if seed > 1 << 20 else self.draw(kind, entity, turn, i), 936)
            if c.isdigit():
                out.append(str(k % 10))
            elif self.script(c) not in ("LATIN", "", *self.LETTERS):
                out.append(self.letter(c, k % 31, k // 31))
            elif (letters := self.LETTERS.get(self.script(c))) or not c.isascii():
                plain, *marks = unicodedata.normalize("NFD", c.lower())
                vowels, others = letters or ("aeiou", "bdfgklmnprstvz")
                pool = vowels if plain in vowels else others
                fits = [x for x in pool if len(unicodedata.normalize("NFC", x + "".join(marks))) == 1] or pool
                new = unicodedata.normalize("NFC", fits[k % len(fits)] + "".join(marks)) if len(fits) < len(pool) or marks else fits[k % len(fits)]
                out.append(new.upper() if c.isupper() else new)
            elif kind == "id_number" or c.isupper():
                out.append("ABCDEFGHJKLMNPQRSTUVWXYZ"[k % 24] if c.isupper() else "abcdefghjklmnpqrstuvwxyz"[k % 24])
            else:
                out.append("aeiou"[k % 5] if c in "aeiou" else "bdfgklmnprstvz"[k % 14])
        return "".join(out)


def rewrite(text: str | None, key: str | None = None) -> str | None:
    """The text with placeholders, or with surrogates if a key is given."""
    spans = mentions(text)
    if not spans:
        return text
    out, last = [], 0
    numbers: dict[tuple[str, str], int] = {}
    counts: dict[str, int] = {}
    made = Surrogates(key, text) if key is not None else None
    entities = entities_of([(kind, text[a:b]) for a, b, kind in spans])
    titles = [(re.findall(r"([^\W\d_]+)\.?\s+$", text[max(0, a - 14) : a]) or [""])[-1] for a, _, _ in spans]
    genders: dict[str, bool] = {}  # what any mention of an entity tells
    for (a, b, kind), who, title in zip(spans, entities, titles):
        if kind == "person" and (told := gender_of(text[a:b], title)) is not None:
            genders.setdefault(who, told)
    for (a, b, kind), who, title in zip(spans, entities, titles):
        out.append(text[last:a])
        if made is not None:
            out.append(made.replace(kind, text[a:b], title, who, genders.get(who)))
        else:
            if (kind, who) not in numbers:
                counts[kind] = numbers[kind, who] = counts.get(kind, 0) + 1
            out.append(f"[{kind.upper()}_{numbers[kind, who]}]")
        last = b
    return "".join([*out, text[last:]])


def redacted(column: Column | str) -> Column:
    """Texts with typed placeholders such as [PERSON_1]."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(rewrite, na_action="ignore")

    return run(column)


def surrogates(column: Column | str, key: str | None = None) -> Column:
    """Texts with keyed surrogates; the key is given, set in the session's KEY_SETTING, or drawn for this call alone."""
    if key is None:
        spark = SparkSession.getActiveSession()
        key = (spark.conf.get(KEY_SETTING, None) if spark else None) or secrets.token_hex(32)
    if not key:
        raise ValueError("an empty key keeps no secret")

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(lambda t: rewrite(t, key), na_action="ignore")

    return run(column)
