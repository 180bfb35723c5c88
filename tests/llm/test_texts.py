"""Operators on texts against tokenizers, brute force, hand-made cases and round trips."""

import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from litweave.llm import canonical, contamination, encoding, pii, sentences

# --- encoding


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{encoding.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


ALPHABET = "abc'stlvreDM  \n\t　 中文。、กขค็ही0 12٣,.-!<|endoftext|>é🙂"


@pytest.mark.parametrize("size", [1, 3, 50])
def test_encoding_random(tokenizer, size):
    r = random.Random(size)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 150))) for _ in range(3000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoding.encode_texts(texts, size=size) == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_encoding_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    whole = encoding.encoder(encoding.BYTE_BPE_50K).encode_ordinary(text)
    assert encoding.encode_texts([text], size=1)[0] == whole
    pairs = encoding.inner_pairs(encoding.BYTE_BPE_50K)
    assert "".join(encoding.fragments(text, pairs, 2)) == text


def test_encoding_query(spark, tokenizer):
    long = "Long text with don't and 中文。 " * 20000
    texts = [None, "", " ", "<|endoftext|>", long, "a", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["ids"] for r in encoding.encoded(df).collect()}
    assert got == {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert encoding.encoded(df.limit(0)).count() == 0


# --- contamination


def brute(docs, items, least):
    out = set()
    for d, t in docs:
        w = contamination.words(t)
        for i, u in items:
            v = contamination.words(u)
            grams = {tuple(v[k : k + least]) for k in range(len(v) - least + 1)}
            if any(tuple(w[k : k + least]) in grams for k in range(len(w) - least + 1)):
                out.add((d, i))
    return out


def test_contamination_brute(spark):
    r = random.Random(4)
    text = lambda n: " ".join(r.choice("abc") + r.choice(["", ".", ","]) for _ in range(n))
    items = [(i, text(9)) for i in range(30)] + [(90, None), (91, ""), (92, "a b"), (0, "a a a a a a")]
    docs = [(i, text(r.randint(0, 60))) for i in range(80)] + [(200, None), (201, ""), (202, items[3][1]), (202, items[3][1]), (None, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    e = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute([x for x in docs if x[0] is not None], items, 5)
    assert len(want) > 20
    for block in (1000, 7):
        got = contamination.matches(d, e, least=5, block=block)
        assert {(x["doc_id"], x["item_id"]) for x in got.collect()} == want
    assert contamination.matches(d, e.limit(0)).count() == 0 and contamination.matches(d.limit(0), e).count() == 0


ITEM = "Researchers compared the cafe naive offices of twelve towns and wrote down what 54-year-old men said"


@pytest.mark.parametrize(
    "change",
    [
        str.upper,
        lambda t: t.replace(" ", "\t \n"),
        lambda t: t.replace("compared", "com-\npared").replace("54-year", "54-\nyear"),
        lambda t: t.replace("offices", "oﬃces").replace("towns", "to­wns").replace("wrote", "wro​te"),
        lambda t: "".join(chr(ord(c) + 0xFEE0) if c.isalnum() and c.isascii() else c for c in t),
        lambda t: f"<p>{t.replace('compared', '<b>compared</b>').replace('towns', '**towns**').replace('said', '_said_')}</p>",
        lambda t: re.sub(" ", ", ", t),
        lambda t: unicodedata.normalize("NFD", t),
    ],
)
def test_contamination_forms(change):
    items = contamination.Items([1], [ITEM])
    got = contamination.shard_matches([5], ["So it is. " + change(ITEM) + " Done."], items)
    assert got[["doc_id", "item_id", "words"]].values.tolist() == [[5, 1, 18]]


def test_contamination_length():
    items = contamination.Items([1], [ITEM])
    w = ITEM.split()
    assert len(contamination.shard_matches([1], [" ".join(w[2:14])], items)) == 1
    assert len(contamination.shard_matches([1], [" ".join(w[2:13])], items)) == 0
    assert len(contamination.shard_matches([1], [" ".join(w[2:13]) + " other " + w[13]], items)) == 0


# --- sentences


def units(text, corpus=None):
    return [text[a:b] for a, b in sentences.Splitter(corpus).spans(text)]


@pytest.mark.parametrize(
    "want",
    [
        ["Dr. Zelo and Prof. Lin met at 9 p.m.", "No effect was seen!", "Is it B (or not?), and if so, why?"],
        ["Loss of A raised levels to 1.84.", "In vivo, B fell by 3% (P < 0.01) (cf. ref. 7).", "We saw lung, liver, etc.", "Nothing else."],
        ["The authors called it “a clear signal.”", "“It failed.” was the only remark of M. D. Kolm.", "(This was not repeated.)", "Then more."],
        ["The complex was stable at 37.5 °C.[4]", "p53 binds it.", "mTOR-like factors were absent.", "The signal ... faded after 3 min in cells."],
        ["Am 28. Mai kam er, d. h. vor der Gabe.", "Im 9. Versuch blieb es stabil.", "Der Bericht nannte dies „ein klares Zeichen.“", "Die Daten (vgl. Abb. 4) zeigen es."],
        ["Aucune perte n'a été observée !", "Les auteurs y voient « un signal clair. »", "D'autres gènes, p. ex. AB5, restent."],
        ["¡No se observó ningún efecto!", "¿Actúa sobre ella?", "Recibieron aprox. 68 mg, p. ej. en el hígado."],
        ["A title line\n\nA sentence.", "Another\none."],
        ["Cells from the U.S. and the U.K. cohorts died.", "It took 24 h.", "Strain P. celer carried it, cf. Suppl. Table 1.", "9 of 88 mice survived."],
    ],
)
def test_sentences_spaced(want):
    parts = [p for w in want for p in w.split("\n\n")]
    assert units(" ".join(want)) == parts
    assert units("  " + "\n".join(want) + " \n") == parts


@pytest.mark.parametrize(
    "want",
    [
        ["報告者は「発現を調節する。」と述べた。", "どう変えるのか？", "対照群は1.83%低下した。"],
        ["作者写道：“受体并不稳定。”", "差异明显！", "剂量为7.73毫克（见图2.1）。"],
        ["Seen in cells.", "In vivo, it failed."],
    ],
)
def test_sentences_joined(want):
    assert units("".join(want)) == want


def test_sentences_other_scripts():
    assert units("डॉ. की राय में यह बदलता है। क्या यह रोकता है?") == ["डॉ. की राय में यह बदलता है।", "क्या यह रोकता है?"]
    assert units("قال د. الفريق إن الجين ينظم. هل يمنع البروتين النمو؟ نعم.") == ["قال د. الفريق إن الجين ينظم.", "هل يمنع البروتين النمو؟", "نعم."]
    assert units("ยีน ZOBK6 ยับยั้งการเผาผลาญ เซลล์ตับลดได้ร้อยละ 82.3 ในตับ") == ["ยีน ZOBK6 ยับยั้งการเผาผลาญ", "เซลล์ตับลดได้ร้อยละ 82.3 ในตับ"]


def test_sentences_from_the_document():
    text = "The Spec. showed it, as the Spec., and (see Spec. Nine) did. We met Spec. Kolmar again."
    assert units(text) == ["The Spec. showed it, as the Spec., and (see Spec. Nine) did.", "We met Spec. Kolmar again."]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB1.!? \n\r()“”\"'。」「ก你।", max_size=60))
def test_sentences_cover(text):
    spans = sentences.Splitter().spans(text)
    assert all(a < b and text[a:b] == text[a:b].strip() for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    covered = {i for a, b in spans for i in range(a, b)}
    assert all(i in covered or c.isspace() for i, c in enumerate(text))


def test_sentence_query(spark):
    df = spark.createDataFrame([(1, 0, "One. Two."), (2, 0, None), (3, 0, ""), (4, -1, " \n "), (5, 0, "word " * 30000 + ".")], "row_id bigint, block_no bigint, text string")
    corpus = sentences.corpus_evidence(df, "text")
    got = [tuple(r) for r in sentences.sentence_units(df, ["row_id", "block_no"], "text", corpus).orderBy("row_id", "sent_no").collect()]
    assert got == [(1, 0, 0, 0, 4), (1, 0, 1, 5, 9), (5, 0, 0, 0, 150001)]
    assert sentences.sentence_units(df.limit(0), ["row_id"], "text", corpus).count() == 0


# --- canonical names

STEMS = "Batrodrast Makriloturn Febemim Goniniak Siarikrist Pavubrern Drestetrulk Zonuleoz Kabriatin Teoflor Nadanel Plotigav Trudenes Sizanil Regraseflolk Miapemum Brofevia Ruzastup Kruzigeg Metomeog Seteobril Voladias Fubreok Gonogram Daflagrer".split()
PROTEINS = [(f"A{i}{k}{o}", [f"{s} {c} {n}", f"{s[:3].upper()}{c[0].upper()}{n}"], org) for i, s in enumerate(STEMS) for k, (c, n) in enumerate((("kinase", 1), ("kinase", 4), ("adaptor protein", "delta"), ("binding factor", 2))) for o, org in enumerate(("Lomaxa fera", "Tarvela gigas"))]


@pytest.fixture(scope="module")
def proteins():
    return canonical.Lexicon(PROTEINS, {"Lomaxa fera": "Lomaxa fera", "L. fera": "Lomaxa fera", "marsh cat": "Lomaxa fera", "Tarvela gigas": "Tarvela gigas", "lake carp": "Tarvela gigas"})


@pytest.mark.parametrize(
    "value",
    [
        "Makriloturn kinase 4", "  MAKRILOTURN KINASE 4", "Makriloturn-kinase-4", "makriloturn_kinase_4", "Makriloturn kin. 4", "kinase 4, Makriloturn", "the Makriloturn kinase no. 4",
        "Makriloturn kinase IV", "MakriloturnKinase4", "recombinant Makriloturn kinase 4", "phospho-Makriloturn kinase 4, wild type", "Makrilxturn kinase 4", "Makrioturn kinases 4", "Makril​oturn kinase 4",
        "Ｍａｋｒｉｌｏｔｕｒｎ ｋｉｎａｓｅ ４", "Mаkriloturn kinase 4", "Makriloturn kínase 4", '"Makriloturn kinase 4".', "Makriloturn kinase 4 (MAKK4)", "makk4", "MAKK4 gene", "marsh cat Makriloturn kinase 4",
    ],
)
def test_canonical_forms(proteins, value):
    assert proteins.match(value, " l. Fera ") == "A110"


@pytest.mark.parametrize(
    ("value", "organism"),
    [
        ("Makriloturn kinase 7", "marsh cat"), ("Makriloturn ligase 4", "marsh cat"), ("Makriloturn kinase", "marsh cat"), ("Makriloturn kinase 4", "swift bat"), ("Makriloturn kinase 4", None), ("lake carp Makriloturn kinase 4", "marsh cat"),
        ("Unheardof kinase 4", "marsh cat"), ("kinase", "marsh cat"), ("12", "marsh cat"), ("???", "marsh cat"), ("n/a", "marsh cat"), ("MAKK9", "marsh cat"), ("Makriloturn adaptor protein beta", "marsh cat"), ("Xakrixxturn kinase 4", "marsh cat"),
    ],
)
def test_canonical_unmatched(proteins, value, organism):
    assert proteins.match(value, organism) == canonical.UNMATCHED


def test_canonical_greek(proteins):
    assert proteins.match("Febemim adapt. prot. δ", "lake carp") == proteins.match("adaptor protein delta Febemim", "T. gigas" if False else "Tarvela gigas") == "A221"


TERMS = [(f"GO:{1000000 + 10 * i + k}", [f"{p}{s.lower()} {c}".strip()] + ([f"up-regulation of {s.lower()} {c}"] if k == 1 else []), None) for i, s in enumerate(STEMS) for c in ("import into nucleus",) for k, p in enumerate(("", "positive regulation of ", "negative regulation of ", "regulation of "))]


@pytest.fixture(scope="module")
def terms():
    return canonical.Lexicon(TERMS)


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("upregulation of febemim import into nucleus", 1), ("neg. regulation of febemim import into nucleus", 2), ("regulating febemim import into nucleus", 3), ("GO: febemim-import into nucleus", 0), ("import into nucleus of febemim", 0),
        ("negatively regulates febemim import into nucleus", 2), ("the process of febemim import into nucleuss in cells", 0), ("positive regulation of import into nucleus, febemim (GO term)", 1), ("GO_1000021", 1),
    ],
)
def test_canonical_terms(terms, value, want):
    assert terms.match(value) == f"GO:{1000020 + want}"


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("GO:1000020", "GO:1000020"), ("go 1000020", "GO:1000020"), ("PARENT:GO:1000020", "GO:1000020"), ("not GO:1000021 but GO:1000020", "GO:1000020"), ("GO:1000020, not GO:1000021", "GO:1000020"), ("<think>maybe GO:1000021?</think>GO:1000020", "GO:1000020"),
        ('{"id": "GO:1000020", "name": "x"}', "GO:1000020"), ("**GO:1000020** (febemim)", "GO:1000020"), ("The best match is febemim import into nucleus.", "GO:1000020"), ("GO:9999999", "UNMATCHED"), ("NONE.", "UNMATCHED"), ("none of the above", "UNMATCHED"),
    ],
)
def test_canonical_answers(terms, value, want):
    assert terms.answer(value) == want


def test_trie_brute():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randint(1, 8)))
    words = {word() for _ in range(200)}
    trie = canonical.Trie(words)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for _ in range(60):
        q = word()
        for k in (0, 1, 2):
            assert trie.near(q, k) == sorted((d, w) for w in words if (d := distance(q, w)) <= k)


def test_trie_swaps_brute():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
    words = {word() for _ in range(200)}
    trie = canonical.Trie(words)

    def distance(a, b):
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
                if i and j and x == b[j - 1] and y == a[i - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    for _ in range(80):
        q = word()
        for k in (0, 1, 2):
            assert trie.near(q, k, swaps=True) == sorted((d, w) for w in words if (d := distance(q, w)) <= k)


CITIES = "San Francisco|Philadelphia|Barcelona|New York|San Diego|Los Angeles|Saint Petersburg|New Orleans|Newark|Boston|Baltimore|Chicago|Houston|Phoenix|San Antonio|Dallas|Indianapolis|Seattle|Denver|Washington|Nashville|Portland|Las Vegas|Memphis|Louisville|Milwaukee|Sacramento|Colorado Springs|Virginia Beach|Minneapolis|Arlington|Bakersfield|Corpus Christi|Cincinnati|Pittsburgh".split("|")
TITLES = [f"{a}{b}" for a in ("", "Senior ", "Junior ", "Lead ") for b in ("Software Engineer", "Data Engineer", "Data Scientist", "Registered Nurse", "Nurse Practitioner", "Project Manager", "Product Manager", "Sales Manager", "Accountant", "Electrician", "Mechanical Engineer", "Teacher", "Business Analyst", "Financial Analyst", "Pharmacist", "Dental Assistant", "Medical Assistant", "Heat Shock Protein", "Process Engineer", "Systems Engineer", "Test Engineer", "Field Engineer", "Sound Engineer", "Security Engineer")]


@pytest.mark.parametrize("names", [CITIES, TITLES])
def test_canonical_on_ordinary_lists(names):
    lex = canonical.Lexicon([(n, [n], None) for n in names])
    assert all(lex.match(n) == n and lex.match(f" {n.upper()} ") == n for n in names)
    r = random.Random(5)

    def mistyped(name):
        at = r.choice([i for i in range(1, len(name)) if name[i].isalpha() and name[i - 1].isalpha()])
        kind = r.randrange(4)
        letter = r.choice("abcdefghijklmnopqrstuvwxyz")
        return name[: at - 1] + name[at] + name[at - 1] + name[at + 1 :] if kind == 3 else name[:at] + ("" if kind == 2 else letter) + name[at + (kind > 0) :]

    asked = [(n, mistyped(n)) for n in names for _ in range(10)]
    assert sum(lex.match(v) == n for n, v in asked) / len(asked) >= 0.9
    assert lex.match("Completely Elsewhere") == canonical.UNMATCHED


def test_canonical_verbatim_and_all_candidates(spark):
    lex = canonical.Lexicon([(n, [n], None) for n in ("Heat Shock Protein", "Unknown", "the Gene", "Karlstadt", "Karlstadd", "p53 binding factor", "HSP70")])
    for n in ("Heat Shock Protein", "Unknown", "the Gene", "HSP70", "hsp 70"):
        assert lex.match(n) != canonical.UNMATCHED, n
    assert lex.candidates("Karlstadt") == {"Karlstadt": 0}
    assert lex.candidates("Karlstads") == {"Karlstadt": 1, "Karlstadd": 1} and lex.match("Karlstads") == canonical.UNMATCHED
    for n in ("p63 binding factor", "HSP71", "HSP7"):
        assert lex.match(n) == canonical.UNMATCHED, n
    df = spark.createDataFrame([(1, "Karlstads", None), (2, None, None), (3, "nowhere", None)], "row_id bigint, value string, organism string")
    assert sorted(map(tuple, canonical.mapped_all(df, lex).collect())) == [(1, "Karlstadd", 1), (1, "Karlstadt", 1)]
    assert canonical.mapped_all(df.limit(0), lex).count() == 0


def test_canonical_query(spark, proteins):
    rows = [(1, "MAKK4", "marsh cat"), (2, None, "marsh cat"), (3, "  ", None), (4, "x " * 20000, "marsh cat"), (5, "MAKK4", "marsh cat")]
    df = spark.createDataFrame(rows, "row_id bigint, value string, organism string")
    assert sorted(map(tuple, canonical.mapped(df, proteins).collect())) == [(1, "A110"), (4, "UNMATCHED"), (5, "A110")]
    assert canonical.mapped(df.limit(0), proteins).count() == 0


# --- personal information


def said(text):
    return [(k, text[a:b]) for a, b, k in pii.mentions(text)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Correspondence to Ms. Zodos KOLMAWORTH, P.O. Box 9474, Velditch 00195 (e-mail: m.hj+x@thaz.test; tel.: +999 41 305 778, ext 218).", [("person", "Zodos KOLMAWORTH"), ("address", "P.O. Box 9474, Velditch 00195"), ("email", "m.hj+x@thaz.test"), ("phone", "+999 41 305 778, ext 218")]),
        ("Please contact Tamielli, Orvan on 020 7946 0968 or write to ward6 (at) lab (dot) example (dot) net.", [("person", "Tamielli, Orvan"), ("phone", "020 7946 0968"), ("email", "ward6 (at) lab (dot) example (dot) net")]),
        ("We thank Nylana Feneander and Osna A. Casoardo for technical help.", [("person", "Nylana Feneander"), ("person", "Osna A. Casoardo")]),
        ("Name: Velkun T. Caseander\nAddress: Vufi House\n25 Vufi Road\nWimmouth\nPhone: (212) 555-0187\nMail: <a_b@c.example>", [("person", "Velkun T. Caseander"), ("address", "Vufi House\n25 Vufi Road\nWimmouth"), ("phone", "(212) 555-0187"), ("email", "a_b@c.example")]),
        ("Nurse Luris von Marosson noted it; NHS no. 999 885 7835 was checked.", [("person", "Luris von Marosson"), ("id_number", "999 885 7835")]),
        ("The record shows Social security number 666-36-4032; home address 1469 N. Gatro Blvd, Suite 943, Ashditch, ZQ 00770.", [("id_number", "666-36-4032"), ("address", "1469 N. Gatro Blvd, Suite 943, Ashditch, ZQ 00770")]),
        ("Patient D. L. Polaez (insurance number 2 99 13 45 687 872 21) was seen.", [("person", "D. L. Polaez"), ("id_number", "2 99 13 45 687 872 21")]),
        ("La patiente Fava Hjeleova, domiciliée 97 bis impasse des Goflaras, 00688 Tamton, a été admise.", [("person", "Fava Hjeleova"), ("address", "97 bis impasse des Goflaras, 00688 Tamton")]),
        ("Der Patient Mornara Borasson, wohnhaft Tolopemolstr. 107, 00132 Dunmsgarde, wurde aufgenommen.", [("person", "Mornara Borasson"), ("address", "Tolopemolstr. 107, 00132 Dunmsgarde")]),
        ("El paciente Osmi van der Borielli, con domicilio en C/ Pobratrer 87, bajo, 00541 Korton, fue ingresado.", [("person", "Osmi van der Borielli"), ("address", "C/ Pobratrer 87, bajo, 00541 Korton")]),
        ("Correspondance : M. Varaez, Oslo, 143 bis avenue des Goflaras, 00688 Tamton. Correspondance : M. E. Poleatti, 3 rue du Lac, 00123 Velton.", [("person", "Varaez, Oslo"), ("address", "143 bis avenue des Goflaras, 00688 Tamton"), ("person", "M. E. Poleatti"), ("address", "3 rue du Lac, 00123 Velton")]),
        ("Correspondencia: D. Dranal Zelaworth, C/ Lago 7, bajo, 00025 Norton. Correspondencia: D. B. Zela.", [("person", "Dranal Zelaworth"), ("address", "C/ Lago 7, bajo, 00025 Norton"), ("person", "D. B. Zela")]),
        ("联系电话：+1 (646) 5550159，邮箱：quedo.wyrelli@tolo.test", [("phone", "+1 (646) 5550159"), ("email", "quedo.wyrelli@tolo.test")]),
        ("Counts were 592 396 7856 per plate; sequence ID SEQ-215-43-9972. ISSN 2029-288X, vol. 90. Catalogue no. 3518-1026-26, lot 555-0188-B.", []),
        ("The avenue of entry is the skin; 91 Street-type stalls were swabbed. Handle @lab posted build 1.6.51.007. Cells were held at 5 µg @ 4 °C.", []),
        ("Kolmimayer syndrome and the Kolmardo stain were named long ago. Trial NCX24208141 enrolled 951 adults from 24 Wimmsgarde wards.", []),
        ("", []), (None, []), ("   ", []),
    ],
)
def test_pii(text, want):
    assert said(text) == want


def test_pii_rewrite():
    text = "Nurse Zodos KOLMA wrote to Ms. Zodos KOLMA and Dr Velna Kolma at a.b@c.test, phone: +44 20 7946 0961. Mail a.b@c.test."
    assert pii.rewrite(text) == "Nurse [PERSON_1] wrote to Ms. [PERSON_1] and Dr [PERSON_2] at [EMAIL_1], phone: [PHONE_1]. Mail [EMAIL_1]." or pii.rewrite(text).count("[EMAIL_1]") == 2
    one, two = pii.rewrite(text, "k"), pii.rewrite(text, "k")
    assert one == two != pii.rewrite(text, "other")
    assert not any(x in one for x in ("Zodos", "KOLMA", "a.b@c.test", "7946"))
    names = [one[a:b] for a, b, k in pii.mentions(one) if k == "person"]
    assert names[0] == names[1] and names[0].split()[1].isupper()
    assert [k for *_, k in pii.mentions(one)] == [k for *_, k in pii.mentions(text)]


def test_pii_distinct():
    text = " ".join(f"Call {n} 555-01{i:02d}." for i in range(60) for n in ["(212)"])
    out = pii.rewrite(text, "k")
    assert len(set(re.findall(r"\(\d+\) [\d-]+", out))) == 60


def test_pii_query(spark):
    rows = [(1, "Call +44 20 7946 0961."), (2, None), (3, ""), (1, "Call +44 20 7946 0961."), (4, "x " * 50000 + "mail a@b.test")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, pii.found(df).collect()))
    assert got == [(1, "phone", 5, 21), (1, "phone", 5, 21), (4, "email", 100005, 100013)]
    out = {r["doc_id"]: r["t"] for r in df.select("doc_id", pii.redacted("text").alias("t")).collect()}
    assert out[1] == "Call [PHONE_1]." and out[2] is None and out[3] == ""
    assert df.select(pii.surrogates("text").alias("t")).where("t like '%7946 0961%'").count() == 0


def test_frames_without_a_cap():
    """Eight abbreviated words with three readings each, 6561 combinations, of which the last one is listed."""
    words = [f"{c}{c}{c}{x}" for c in "abcdefgh" for x in "xyz"]
    fill = [(f"F{i}{j}", [f"{w} {v} {chr(97 + j)}ofill{i}"], None) for i, w in enumerate(words) for j, v in enumerate(words) if w != v]
    lex = canonical.Lexicon([*fill, ("T", ["tarnol " + " ".join(w for w in words if w[-1] == "z")], None)])
    assert set(words) <= lex.frames
    assert lex.match("tarnol " + " ".join(f"{c * 3}." for c in "abcdefgh")) == "T"


def test_own_words_are_ranked_after_the_frame():
    words = [f"word{chr(97 + i)}" for i in range(24)]
    fill = [(f"F{i}{j}", [f"{w} {v} filler"], None) for i, w in enumerate(words) for j, v in enumerate(words) if w != v]
    lex = canonical.Lexicon([*fill, ("A", ["tarnol worda"], None), ("B", ["tarnil wordb"], None)])
    assert lex.match("tarnol worda") == "A"
    assert lex.match("tarnel wordb") == "B"
    assert lex.match("tarnol wordb") == "B"


def test_corpus_evidence_does_not_fade_with_the_corpus(spark):
    rare = [("It is in subbibliogr. and so on.",)] * 4
    df = spark.createDataFrame([*rare, ("word " * 450_000,)], "text string")
    corpus = sentences.corpus_evidence(df, "text")
    assert corpus.nonfinal["subbibliogr"] == 4
    assert sentences.Splitter(corpus).is_abbreviation("subbibliogr", sentences.Evidence())


def test_surrogates_keep_the_script():
    made = pii.Surrogates("k", "")
    for name, script in (("Анна Петрова", "CYRILLIC"), ("Νίκος Αλεξίου", "GREEK"), ("Anna Petrova", "LATIN")):
        got = made.replace("person", name)
        assert got != name and {made.script(c) for c in got if c.isalpha()} == {script}
    assert {made.script(c) for c in made.replace("address", "Невский 12") if c.isalpha()} == {"CYRILLIC"}
    for kind, name in (("person", "Zoë Muñoz"), ("address", "Łódźka 5")):
        got = made.replace(kind, name)
        assert got != name and not got.isascii()


def test_words_broken_over_many_lines_and_long_tags():
    broken = "This is im-\nmu-\nno-\nsup-\npres-\nsion " + "-\n".join("word" for _ in range(60)) + " here"
    known = {w: 1 for w in ["immunosuppression", "word", "this"]}
    assert contamination.words(broken, known) == ["this", "is", "immunosuppression", *["word"] * 60, "here"]
    assert contamination.words("ab-\ncd-\nef") == ["abcdef"]
    items = contamination.Items([1], [ITEM])
    tagged = ITEM.replace(" ", f' <a href="{"x" * 5000}">', 3).replace("towns", f'to<b class="{"y" * 3000}">wns</b>')
    assert contamination.shard_matches([5], [tagged], items)["words"].tolist() == [18]


def test_suffix_array_is_sorted_to_full_depth():
    r = __import__("numpy").random.default_rng(2)
    for least in (1, 3):
        flat = __import__("numpy").concatenate([r.integers(0, 4, 400), [1, 2] * 60, [0], [1, 2] * 60, [0]])
        starts = contamination.whole_starts(flat, least)
        array = contamination.suffix_array(flat, starts, least)
        assert sorted(array) == sorted(starts)

        def known(i, flat=flat):
            end = next((k for k in range(i, len(flat)) if flat[k] == 0), len(flat))
            return flat[i:end].tolist()

        assert all(known(a) <= known(b) for a, b in zip(array, array[1:]))


def test_every_longest_match_is_located_and_tails_are_not():
    r = random.Random(9)
    word = [f"w{i}" for i in range(6)]
    texts = [" ".join(r.choice(word) for _ in range(40)) for _ in range(12)]
    asked = [" ".join(r.choice(word) for _ in range(20)) for _ in range(6)]
    items = contamination.Items(list(range(6)), asked, least=3)
    got = sorted(map(tuple, contamination.shard_matches(list(range(12)), texts, items).values.tolist()))
    want = []
    for d, t in enumerate(texts):
        for i, u in enumerate(asked):
            a, b = t.split(), u.split()
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                    if n >= 3 and not (x and y and a[x - 1] == b[y - 1]):
                        want.append((d, i, x, y, n))
    assert got == sorted(want) and want


def test_copies_times_items_make_one_pair_each():
    """400 documents and 400 items share 40 words: one match each pair, though the passage has 29 places to begin."""
    passage = " ".join(f"w{i}" for i in range(40))
    items = contamination.Items(list(range(400)), [f"item{i} {passage}" for i in range(400)])
    parts = list(contamination.shard_parts(list(range(400)), [f"doc {passage} end"] * 400, items))
    assert sum(map(len, parts)) == 160_000 and {int(w) for p in parts for w in p["words"].unique()} == {40}
    assert max(map(len, parts)) <= 2 * contamination.PAIRS


def test_the_document_decides_before_the_list():
    text = "She ate a fig. Then she ate another fig. In the yard a fig tree grew."
    assert units(text) == ["She ate a fig.", "Then she ate another fig.", "In the yard a fig tree grew."]
    assert units("It is shown in Fig. A and in the fig. Nine rows.") == ["It is shown in Fig. A and in the fig. Nine rows."]
    assert units("The fig tree is shown in fig. 3 of the book.") == ["The fig tree is shown in fig. 3 of the book."]
    assert units("Dr Smith came. Then Dr. Smith and Dr. Jones left.") == ["Dr Smith came.", "Then Dr. Smith and Dr. Jones left."]
    corpus = sentences.Corpus()
    corpus.used["fig"] = 5
    assert units("She ate a fig. Then she left.", corpus) == ["She ate a fig.", "Then she left."]
    corpus.nonfinal["fig"] = 50
    assert len(units("She ate a fig. Then she left.", corpus)) == 1


@pytest.mark.parametrize("n", [1, 40, 200])
def test_brackets_of_any_length(n):
    inside = " ".join("One more sentence." for _ in range(n))
    assert units(f"It was seen ({inside} End here.) in cells. Then more.") == [f"It was seen ({inside} End here.) in cells.", "Then more."]


def test_words_longer_than_the_window():
    word = "a" * 500
    assert units(f"He met {word}. Then more.") == [f"He met {word}.", "Then more."]
    assert units(f"So {word}., as {word}., and {word}. Then more.") == [f"So {word}., as {word}., and {word}. Then more."]


def test_corpus_evidence_joined_and_at_hand_agree(spark):
    texts = ["It is in bibliogr. and so on."] * 4 + ["See Zelnik. and more, or zelnik works."] * 3 + ["He read the bibliogr. Zelnik was there. The qualif. Zelnik. Then came the fig. Then more."] * 2 + ["we see a fig tree here"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[-4])], "row_id bigint, text string")
    want = None
    for hot in (1000, 2, 0):
        corpus = sentences.corpus_evidence(df, "text", hot_words=hot)
        assert (corpus.others is None) == (hot == 1000)
        got = sorted(map(str, sentences.sentence_units(df, ["row_id"], "text", corpus).collect()))
        want = want or got
        assert got == want


def test_units_do_not_change_with_the_size_of_the_corpus(spark):
    own = ["It is in bibliogr. and so on.", "He read the bibliogr. Zelnik was there."] * 4
    small = spark.createDataFrame([(i, t) for i, t in enumerate(own)], "row_id bigint, text string")
    large = spark.createDataFrame([(i, t) for i, t in enumerate(own + ["Other words fill this text, many of them."] * 90)], "row_id bigint, text string")
    units_of = lambda df: {tuple(r) for r in sentences.sentence_units(df, ["row_id"], "text", sentences.corpus_evidence(df, "text")).collect() if r["row_id"] < 8}
    assert units_of(small) == units_of(large) and len(units_of(small)) == 8


def scripts_of(text):
    return {pii.Surrogates.script(c) for c in text if c.isalpha()}


@pytest.mark.parametrize("name", ["王伟", "अनीता शर्मा", "محمد علي", "김민수", "สมชาย ใจดี", "たなか", "Анна Петрова", "Νίκος Αλεξίου", "דוד לוי"])
def test_surrogates_keep_every_script(name):
    made = pii.Surrogates("k", "").replace("person", name)
    assert made != name and scripts_of(made) == scripts_of(name) and len(made.split()) == len(name.split())
    assert made == pii.Surrogates("k", "").replace("person", name)


def test_surrogates_keep_the_gender():
    made = pii.Surrogates("k", "")
    given = lambda name, title="": made.replace("person", name, title).split()[0]
    assert given("Jennifer Smith").endswith("a") and given("Luca Rossi").endswith("o") and given("Nikita Popov").endswith("o")
    assert given("Vikram Rao", "Mrs").endswith("a")
    assert made.replace("person", "Ольга Петрова").endswith("ова") and made.replace("person", "Иван Петров").endswith("ов")


def test_distinct_people_stay_distinct_and_one_stays_one():
    text = "Dr. Smith met Mary Smith and John Brown. Later Dr. Brown and M. Smith left with Mary Smith."
    red = pii.rewrite(text)
    assert red == "Dr. [PERSON_1] met [PERSON_1] and [PERSON_2]. Later Dr. [PERSON_2] and [PERSON_1] left with [PERSON_1]."
    out = pii.rewrite(text, "secret")
    assert "Smith" not in out and "Brown" not in out
    many = ", ".join(f"Mary K{chr(97 + i)}l{chr(97 + j)}n" for i in range(20) for j in range(20))
    people = re.findall(r"[^,]+", pii.rewrite(many, "secret"))
    assert len({p.strip() for p in people}) == 400


def test_people_without_an_introduction():
    found = lambda t: [t[a:b] for a, b, k in pii.mentions(t) if k == "person"]
    assert found("John Smith went home.") == ["John Smith"]
    assert found("The lab manager, Maria Lopez, was asked.") == ["Maria Lopez"]
    assert found("患者王伟因头痛就诊。王伟说没事。") == ["王伟", "王伟"] and found("患者 王伟，男") == ["王伟"] and found("姓名：李秀英。") == ["李秀英"]
    assert found("Peter Pan syndrome and the John Radcliffe Hospital") == []


def test_surrogates_have_no_published_key(spark):
    df = spark.createDataFrame([("Dr. Mary Smith came.",)], "text string")
    one, two = (df.select(pii.surrogates("text").alias("t")).first()["t"] for _ in range(2))
    assert one != two
    spark.conf.set(pii.KEY_SETTING, "a secret")
    try:
        one, two = (df.select(pii.surrogates("text").alias("t")).first()["t"] for _ in range(2))
        assert one == two
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    with pytest.raises(ValueError):
        pii.surrogates("text", "")


def test_label_pieces_come_from_the_labels():
    assert pii.literals("a(?:b|c)?[de]\\.?") == {"ad", "ae", "abd", "abe", "acd", "ace", "ad.", "ae.", "abd.", "abe.", "acd.", "ace."}
    assert "national insurance number" in pii.literals(pii.ID_LABELS) and "correspondence to" in pii.literals(pii.PHRASES)
