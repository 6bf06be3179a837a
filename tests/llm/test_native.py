"""The DataFrame-only operators against plain Python: mixing, personal data, secrets, licenses."""

import hashlib
import math
import random
import re

import pytest

from curvelake.llm import licenses, mixing, pii, secrets
from curvelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string, lang string, base string, row string, number long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *([""] * (3 - len(r))), "en", "b", "r", 7) for r in rows], SCHEMA).repartition(3)


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]


# --- mixing ---------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, budget=1.5, cap=2.0):
    total = budget * sum(sizes.values())
    out, open_ = {s: 0.0 for s in sizes}, set(sizes)
    while open_:
        left = total - sum(out[s] for s in sizes if s not in open_)
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] >= cap * sizes[s]}
        if not over:
            out.update(share)
            break
        out.update({s: cap * sizes[s] for s in over})
        open_ -= over
    return out


def check_mix(rows, got):
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    target = fill(sizes, {s: [3, 1, 2][i % 3] for i, s in enumerate(sources)})
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r[0] or -1, size(r[1])) for r in rows)
    taken = dict.fromkeys(sources, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sources:
        assert abs(taken[s] - target[s]) <= 1 + len(rows) / mixing.BUCKET_ROWS


def test_mixing_whole_table(spark):
    rows = documents(spark)
    first = QUERIES["op2_mixing"](spark, SF).collect()
    check_mix(rows, first)
    again = QUERIES["op2_mixing"](spark, SF).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_mixing_odd_rows(spark):
    rows = [(1, "a b c", "z"), (2, None, "z"), (3, "", "empty"), (4, "x " * 5000, None), (5, "y", None), (6, "b\x0bc d é", "Z"),
            (7, "q w e", "é"), (7, "q w e", "é"), (None, "n u l l", "z"), (8, "t", "𐀀"), (9, "u", "￿")]
    check_mix(rows, mixing.mix(frame(spark, rows)).collect())


def test_mixing_buckets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(0, 90), "hot" if i % 3 else f"s{i % 12}") for i in range(900)]
    got = mixing.mix(frame(spark, rows), bucket_rows=50).collect()
    check_mix(rows, got)


def test_mixing_empty_and_no_words(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [(r.target, r.taken) for r in mixing.mix(frame(spark, [(1, " ", "a"), (2, None, None)])).collect()] == [(0.0, 0)] * 2


def test_mixed_documents(spark):
    rng = random.Random(2)
    rows = [(i, f"d{i} " * rng.randrange(0, 30), f"s{i % 4}") for i in range(200)] + [(1, "same", "s1"), (1, "same", "s1")]
    docs = frame(spark, rows)
    want = {}
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.source] = want.get((r.doc_id, r.source), 0) + r.taken
    want = {k: v for k, v in want.items() if v}
    got = {}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert any(t.startswith(r.text) for d, t, s in rows if (d, s) == (r.doc_id, r.source))
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(WORD.findall(r.text))
    assert want == got


def test_cut_has_many_words(spark):
    rows = [(1, " " + "word, \n" * 30_000, "a"), (2, "x", "b"), (3, "x", "c")]
    got = [len(r.text.split()) for r in mixing.mixed_documents(frame(spark, rows), weights=(2.0, 1.0), budget=0.7).collect() if r.doc_id == 1]
    assert got == [r.taken for r in mixing.mix(frame(spark, rows), weights=(2.0, 1.0), budget=0.7).collect() if r.doc_id == 1]


# --- personal data and secrets ----------------------------------------------------

def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    return [[(k, m.start(), m.end()) for m in re.finditer(p, text or "") if ok(m[0])] for k, p, ok in rules]


def plain_secrets(text):
    key = "(password|passwd|secret|token|api_?key)"
    for word in ("password", "passwd", "secret", "token", "api", "key"):
        key = re.sub(rf"\b{word}\b|(?<=[(|]){word}|(?<=\?){word}", "".join(f"[{c}{c.upper()}]" for c in word), key)
    rules = [("assign", key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32)]
    return [[(k, m.start(), m.end()) for m in re.finditer(p, text or "") if ok(m)] for k, p, ok in rules]


def digest(spans):
    flat = sorted((s, i, e, k) for i, own in enumerate(spans) for k, s, e in own)
    text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in flat)
    return (*[len(own) for own in spans], hashlib.sha256(text.encode()).hexdigest()), text


PII_TEXTS = [
    None, "", "a@b.c", "x a.b+c@d-e.f.g. a@@b.c a@b a@.b a@b..c", "a@b.c@d.e x@y.z_w@q.r é@é.com é.x@y.com", "@x.y", "a@b.c-d@e.f",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 001.02.3.0004 255.255.255.255 1.1.1.1111111111111111111111 ٣.1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111  1111 1111 1111 41111111111111110 4111 1111 1111 1112",
    "12345678901234567890 0000 0000 0000 00 00000000000000000000 - 5 5", "+1 (988) 555-2485, +12 +1234567890123456 +44.20.7946.0958 +1 ) 2 ++1 2345678901",
    "+1" + " " * 300 + "x +1 234 567 89012 3", "日本 a@b.co 日 +1 (988) 555-2485 \U0001f600 1.2.3.4", "a" * 3000 + "@b.c " + "1 " * 2000 + "+1 " * 50,
    "a@b" + ".c" * 3000, "." * 3000 + "1" * 3000]
SECRET_TEXTS = [
    None, "", "password=abc12345 PassWord: 'abcdefgh' passwd='x' secret\"  :  \"abcdefg\" token==abcdefgh api_key=12345678 APIKEY:12345678 api__key=123456789",
    "password = password=abcdefgh tokentoken:::abcdefgh secret:=abcdefgh ſecret=abcdefgh toKen=abcdefgh", "AKIA1234567890AB AKIA1234567890A AKIAAKIA12345678 xAKIA123456789012é",
    "0123456789abcdef0123456789abcdef 0123456789abcdef0123456789abcde 0123456789abcdef0123456789abcdef0 F0123456789abcdef0123456789abcdef",
    "日本 token = \"deadbeefdeadbeefdeadbeefdeadbeef\" \U0001f600 password=ééé", "password" + " " * 3000 + "= x", "a" * 5000, "token=" + "ab/+" * 3000]


def check_base(spark, plain, run, rows):
    got = {}
    for r in run(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for d, text, *_ in rows:
        want, spans = digest(plain(text))
        for r in got[d]:
            n = len(want)
            assert tuple(r)[1:1 + n] == want, (d, text and text[:80], tuple(r), spans[:200])
            assert r.n_added > 0 or r.spans == spans
            assert not spans or set(spans.split(",")) <= set(r.spans.split(","))


def test_pii_base(spark):
    rows = list(enumerate(PII_TEXTS)) + [(None, "a@b.c"), (2, "a@b.c")]
    check_base(spark, plain_pii, lambda d: pii.summary(pii.extract(d)), rows)


def test_pii_whole_table(spark):
    check_base(spark, plain_pii, lambda d: QUERIES["op4_pii"](spark, SF), documents(spark))


def test_pii_bootstrap(spark):
    rng = random.Random(5)
    rows = [(i, f"text about it. Contact mail: u{i}@host{i}.org now {rng.choice('abc')}") for i in range(40)]
    rows += [(100, "text. Contact mail: u77_at_host77 now a"), (103, "text. Contact mail: password=0123456789 now a"), (101, "chapter 12345 of the book"), (102, "Room 12345 is closed")]
    got = {r.doc_id: r.spans for r in pii.summary(pii.extract(frame(spark, rows))).collect()}
    at = rows[40][1].index("u77")
    assert got[100] == f"email:{at}:{at + len('u77_at_host77')}"
    assert got[101] == got[102] == got[103] == ""


def test_secrets_base(spark):
    rows = list(enumerate(SECRET_TEXTS)) + [(None, "token=12345678"), (5, "token=12345678")]
    rows = [r for r in rows if r[0] != 5 or r[1] == "token=12345678"] + [(50, SECRET_TEXTS[5])]
    check_base(spark, plain_secrets, lambda d: secrets.summary(secrets.scan(d)), rows)


def test_secrets_whole_table(spark):
    check_base(spark, plain_secrets, lambda d: QUERIES["op6_secrets"](spark, SF), documents(spark))


def test_random_tokens_are_found(spark):
    rng = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(letters) for _ in range(48)) for _ in range(20)]
    words = ["the", "of", "and", "nation", "tion", "there", "blend", "erha", "on", "is", "was", "at"]
    rows = [(i, " ".join(rng.choices(words, k=200)) + f" {k} end") for i, k in enumerate(keys)]
    rows += [(100 + i, " ".join(rng.choices(words, k=100)) + " " + "-".join(rng.choices(words, k=12)) + str(i)) for i in range(60)]
    rows += [(300, "x1" * 40), (301, "abcdefghijklmnopqrstuvwxyz0123456789"), (302, "the_quick_brown_fox_jumps_over_2_lazy_dogs")]
    got = {r.doc_id: r for r in secrets.summary(secrets.scan(frame(spark, rows))).collect()}
    hits = [i for i, k in enumerate(keys) if f"random:{rows[i][1].index(k)}:" in got[i].spans]
    assert len(hits) >= 18
    assert not {i: (got[i].spans, dict(rows)[i]) for i in got if i >= 100 and got[i].spans}


def test_letters_digits_and_short_tokens(spark):
    rng = random.Random(12)
    words = ["the", "of", "and", "nation", "tion", "there", "blend", "erha", "on", "is", "was", "at"]
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    keys = ["".join(rng.choices(upper + lower, k=48)) for _ in range(12)] + ["".join(rng.choices(lower, k=90)) for _ in range(12)]
    keys += ["".join(rng.choices(digits, k=31)) for _ in range(6)]
    keys += ["".join(rng.sample(upper + lower + digits, 18)) for _ in range(12)]
    number = lambda: f"{rng.choice([10, 20, 100, 1000, 12, 11])}"
    rows = [(i, " ".join(w for _ in range(200) for w in (rng.choice(words), number())) + f" {k} end") for i, k in enumerate(keys)]
    rows += [(100 + i, " ".join(rng.choices(words, k=100)) + " " + "".join(rng.choices(words, k=4 + i % 9))) for i in range(60)]
    rows += [(300, "10" * 15), (301, "internationalizations telecommunications/electrical-engineering"), (302, "thethethethethethethethe")]
    got = {r.doc_id: r for r in secrets.summary(secrets.scan(frame(spark, rows))).collect()}
    hits = [i for i, k in enumerate(keys) if f"random:{rows[i][1].index(k)}:{rows[i][1].index(k) + len(k)}" in got[i].spans]
    of = [sum(low <= i < high for i in hits) for low, high in ((0, 12), (12, 24), (24, 30), (30, 42))]
    assert of[0] >= 11 and of[1] >= 11 and of[2] >= 5 and of[3] >= 11, of
    assert not {i: (got[i].spans, dict(rows)[i]) for i in got if i >= 100 and got[i].spans}


def test_redact(spark):
    rows = [(1, "é token=12345678 x AKIA1234567890AB, password=0123456789abcdef0123456789abcdef."), (2, None), (3, "clean"), (3, "clean"), (None, "token=12345678")]
    docs = frame(spark, rows)
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, "é [SECRET] x [SECRET], [SECRET]"), (2, None), (3, "clean"), (3, "clean"), (None, "[SECRET]")], key=str)


@pytest.mark.parametrize("run", [lambda d: pii.summary(pii.extract(d)), lambda d: secrets.summary(secrets.scan(d)),
                                 lambda d: licenses.summary(licenses.scan(d)), mixing.mixed_documents, secrets.redact])
def test_empty(spark, run):
    assert run(frame(spark, [])).count() == 0


# --- licenses -------------------------------------------------------------------

def plain_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    return (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))


def check_licenses(rows, got):
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for d, text, *_ in rows:
        r = by[d].pop()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(text), (d, text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert not any(by.values())


def test_licenses_whole_table(spark):
    got = QUERIES["op9_licenses"](spark, SF).collect()
    check_licenses(documents(spark), got)
    assert {r.base_labels for r in got if "apache-2.0-line" in r.labels} == {"apache"}


def test_licenses_odd_rows(spark):
    mit = dict(licenses.TEMPLATES)["mit-text"]
    edited = mit.split()
    edited[10:10] = ["indeed", "really"]
    del edited[40]
    rows = [(1, None), (2, ""), (3, "CC-BY, cc  by; ccby cc\nBY"), (4, "MIT License mit LICENSE"), (5, "the é Apache\tLicense2 apache license"),
            (6, "x " * 50 + mit + " y" * 20), (7, " ".join(edited)), (8, "two words"), (9, "GNU gnu general public license"), (None, "cc by"),
            (10, mit[:120]), (11, "w " * 40_000 + "cc by"), (4, "MIT License mit LICENSE")]
    got = licenses.summary(licenses.scan(frame(spark, rows))).collect()
    check_licenses(rows, got)
    by = {r.doc_id: r for r in got}
    assert by[6].labels == "mit-text" and by[6].score == 1.0
    assert by[7].labels == "mit-text" and 0.9 < by[7].score < 1
    assert by[10].labels == "" and by[10].score == 0
    near = licenses.summary(licenses.scan(frame(spark, [(1, "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0.")]))).first()
    assert near.labels == "cc-by,cc-by-nc-4.0-line,cc-by-sa-4.0-line"
    one = licenses.summary(licenses.scan(frame(spark, [(1, "x Licensed under CC BY-NC 4.0. y")]))).first()
    assert (one.labels, one.score) == ("cc-by,cc-by-nc-4.0-line", 1.0)


def test_every_named_template_needs_its_name():
    unnamed = {label for label, words in licenses.template_words().items()
               if not any(" ".join(n) in " ".join(words) for n in [v.split() for names in licenses.NAMES.values()
                                                                   for v in ([names] if isinstance(names, str) else names)])}
    assert unnamed == {"mit-text", "bsd-text"}
    for label, words in licenses.template_words().items():
        need = {i for run in licenses.deciding(label, words)[0] for i in run}
        assert label in unnamed or need, label


def test_other_licenses_are_not_taken_for_known_ones(spark):
    texts = ["The album was released under the Apple label.", "Students work under the MIT banner.",
             "Licensed under the Eclipse Public License, Version 2.0", "Licensed under the Mozilla Public License, Version 2.0.",
             "Licensed under the European Union Public License, Version 1.1", "This work is licensed under the Open Software License, version 3.",
             "This work is licensed under a Creative Works Attribution 4.0 International License.", "Released under the ISC License.",
             "Licensed under the Academic Free License, Version 2.0.", "Licensed under CD BY 4.0."]
    got = licenses.scan(frame(spark, list(enumerate(texts)))).collect()
    assert {texts[r.doc_id]: r.labels for r in got if r.labels} == {}
    known = {"Licensed under the Apache License, Version 2.0": "apache-2.0-line", "released under the MIT license!": "mit-line",
             "This work is licensed under the GNU General Public License, version 3": "gpl-3.0-line",
             "Licensed under CC BY 4.0": "cc-by-4.0-short-line",
             "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0-line",
             "Intro. " + dict(licenses.TEMPLATES)["mpl-2.0-notice"] + " More.": "mpl-2.0-notice"}
    got = {r.doc_id: r.labels for r in licenses.scan(frame(spark, list(enumerate(known)))).collect()}
    assert all(label in got[i] for i, label in enumerate(known.values()))


def test_licenses_of_a_family(spark):
    mit = dict(licenses.TEMPLATES)["mit-text"].split()
    texts = {"This work is licensed under the GNU General Public License, version 2": {"gpl-2.0-line"},
             "licensed under the GNU Lesser General Public License version 3": {"lgpl-3.0-line"},
             "This work is licensed under the GNU General Public License, version 3.": {"gpl-3.0-line"},
             "Licensed under the Apache License, Version 1.1": {"apache-1.1-line"}, "Licensed under the Apache License, Version 2.0": {"apache-2.0-line"},
             "Licensed under the Apache License, Version 9.7": set(), "Licensed under CC BY-ND 4.0": {"cc-by-nd-4.0-line"},
             "Licensed under CC BY-NC-SA 4.0": {"cc-by-nc-sa-4.0-line"}, "Licensed under CC BY-SA 4.0.": {"cc-by-sa-4.0-line"},
             "Licensed under CC BY-NC 3.0.": set(),
             " ".join([*mit[:len(mit) // 2], "Page", "4", "of", "12,", "printed", *mit[len(mit) // 2:]]): {"mit-text"}}
    rows = [(i, f"some words here {t} and others there") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    assert {i: set(got[i].labels) - set(got[i].base_labels) for i, _ in rows} == dict(enumerate(texts.values()))
    assert got[len(texts) - 1].score == 1.0
