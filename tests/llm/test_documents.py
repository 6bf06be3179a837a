"""Quality rules, SimHash and the pipeline against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from curvelake.llm import quality, secrets, simhash
from curvelake.llm.queries import QUERIES, tokenizer_file
from tests.llm.test_native import check_mix, plain_secrets

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string, fp long, row string, host string, _fp string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *([None] * (3 - len(r))), 1, "r", "h", "f") for r in rows], SCHEMA).repartition(3)


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]


# --- SimHash --------------------------------------------------------------------

def print_of(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, bits=2):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {p: find(p) for p in distinct}


def brute_simhash(rows):
    prints = [print_of(r[1]) for r in rows]
    root = classes(prints)
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[root[p]] = min(least.get(root[p], r[0]), r[0])
    return sorted(((r[0], f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints)), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def edited(rng, groups=30, alone=200):
    words = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(60, 400))]
        for _ in range(rng.randrange(2, 9)):
            own = list(base)
            own[rng.randrange(len(own))] = "edit"
            rows.append((n, " ".join(own), "s"))
            n += 1
    return rows + [(n + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))), "s") for i in range(alone)]


ODD = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one two"), (905, "ONE two"), (906, "one two three"), (907, "É é e"),
       (908, "x " * 50_000), (908, "x " * 50_000), (None, "one two"), (None, "unlike anything else at all"), (909, "a\x0bb c d")]


def test_simhash_whole_table(spark):
    assert result(QUERIES["op3_simhash"](spark, SF)) == brute_simhash(documents(spark))


@pytest.mark.parametrize("shard_rows", [50_000, 20])
def test_simhash_made_rows(spark, shard_rows):
    rows = edited(random.Random(shard_rows)) + ODD
    got = result(simhash.near_duplicates(frame(spark, rows), shard_rows=shard_rows))
    want = brute_simhash(rows)
    assert got == want and len({r[2] for r in want}) < len(want) - 20


def test_simhash_dense_fingerprints(spark):
    """Chains and stars of fingerprints, over shards."""
    rng = random.Random(9)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(60):
            prints.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.3:
                x ^= 1 << rng.randrange(64)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = {r.fp % (1 << 64): r.root for r in simhash.classes(spark.createDataFrame(signed, "fp long"), shard_rows=40).collect()}
    want = classes(prints)
    assert set(got) == prints
    pairs = {(want[p], got[p]) for p in prints}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_keep_one(spark):
    rows = edited(random.Random(3)) + ODD
    docs = frame(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    root = classes([print_of(r[1]) for r in rows])
    groups = defaultdict(list)
    for r in rows:
        groups[root[print_of(r[1])]].append(r)
    want = []
    for own in groups.values():
        low = min(own, key=lambda r: (r[0] is None, r[0] or 0))
        want.append(low[0])
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.keep_one(frame(spark, [])).count() == 0
    assert quality.judge(frame(spark, [])).count() == 0


# --- quality ----------------------------------------------------------------------

def brute_quality(rows, rules=quality.Rules()):
    normal = lambda line: " ".join(line.split()).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"))
    split = lambda t: [x.decode() for x in (t or "").encode().split()]
    hashed = lambda s: hashlib.md5(s.encode()).hexdigest()
    seen, texts, measured = defaultdict(set), defaultdict(set), []
    for d, t, host in rows:
        words, lines = split(t), defaultdict(int)
        raw = [x for x in (t or "").split("\n") if split(x)]
        for x in raw:
            lines[hashed(normal(" ".join(split(x))))] += len(split(x))
        for x in lines:
            seen[host, x].add(min((y for y in lines if y != x), default=""))
        texts[host].add(t)
        windows = defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i:i + 5])].append(i)
        again = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
        measured.append((d, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(raw) - len(set(raw)), len(again), lines, host))
    out = []
    for d, n, chars, symbols, dup, again, lines, host in measured:
        limit = max(rules.min_documents, len(texts[host]) * rules.max_share)
        gone = sum(c for x, c in lines.items() if len(seen[host, x]) > limit)
        base = n < rules.min_words or 100 * again > rules.max_repeat_percent * n
        depleted = gone > 0 and n - gone < rules.enough_words and n - gone < n * rules.min_left
        out.append((d, n, chars, symbols, dup, again, base, not base and not depleted))
    return sorted(out, key=str)


def verdicts(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


def test_quality_whole_table(spark):
    assert verdicts(QUERIES["op10_quality"](spark, SF)) == brute_quality(documents(spark))


def test_quality_boilerplate(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(2000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    menu = "Home | About us | Contact 2024 | Subscribe to our letter now"
    foot = "All rights reserved by the host of these many pages and more"
    rows = [(i, f"{menu}\n{text(60)}\n{foot}", "a") for i in range(60)]            # lines on real pages
    rows += [(100 + i, f"{menu}\n{text(3)}\n{foot}", "a") for i in range(15)]       # hardly anything else
    page = [text(14) for _ in range(6)]
    rows += [(200 + i, "\n".join(page[:5] + [page[5] + f" {i}"]), "b") for i in range(300)]   # near copies
    rows += [(600 + i, "\n".join(page), "b") for i in range(300)]                             # exact copies
    rows += [(1000, None, None), (1001, "", "a"), (1002, "\n \n#*$", "é"), (None, text(30), "a"), (1003, text(20) + "\n" + text(20), None)]
    rows += [rows[0], (1004, "a b c d e f g h i j " * 2, "c"), (1005, "x " * 30_000, "c")]
    got = verdicts(quality.judge(frame(spark, rows)))
    assert got == brute_quality(rows)
    kept = {r[0]: r[7] for r in got}
    assert all(kept[i] for i in range(60)) and not any(kept[100 + i] for i in range(15))
    assert all(kept[i] for i in kept if i is not None and 200 <= i < 1000)
    good = quality.keep_good(frame(spark, rows))
    assert sorted((r.doc_id for r in good.collect()), key=str) == sorted((r[0] for r in got if r[7]), key=str)


@pytest.mark.parametrize("shared, own, n", [(20, 1, 100), (40, 1, 200), (30, 3, 100), (20, 1, 500)])
def test_quality_shared_lines_do_not_hide(spark, shared, own, n):
    rng = random.Random(shared + own + n)
    text = lambda n: " ".join(f"w{''.join(rng.choices('abcdefgh', k=5))}" for _ in range(n))
    menu = [[text(6) for _ in range(shared)] for _ in range(6)]
    section = [[text(3) for _ in range(20)] for _ in range(n // 20)]   # lines of 20 pages each: below the limit
    rows = [(1000 * h + i, "\n".join([*menu[h], *(section[i // 20] if h % 2 else []), *[text(4) for _ in range(own)]]), f"h{h}")
            for h in range(6) for i in range(n)]
    documents = defaultdict(set)  # brute force: distinct texts of a host that have the line
    for _, t, h in rows:
        for x in t.split("\n"):
            documents[h, x].add(t)
    want = {d: sum(len(x.split()) for x in t.split("\n") if len(documents[h, x]) > max(20, 0.02 * n)) for d, t, h in rows}
    assert set(want.values()) == {6 * shared}
    assert {r.doc_id: r.n_removed for r in quality.judge(frame(spark, rows)).collect()} == want


def test_frequent_lines_leave_texts(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}é" for _ in range(n))
    menu = lambda i: f"Home |  About\u00a0us\t| Contact {i % 7} \r"
    foot = "ALL rights reserved by the Host"
    own = [(text(30), text(30)) for _ in range(40)]
    rows = [(i, f"{menu(i)}\n{a}\n\n{foot}\n{b}\n{foot.lower()}", "a") for i, (a, b) in enumerate(own)]
    rows += [(100, f"{foot}\n{text(20)}\n", "b"), (101, f"{menu(0)}\n" * 30 + text(60), "a"), rows[0], (None, rows[1][1], "a"), (102, rows[2][1], None)]
    want = [(d, t if h != "a" else "\n".join(x for x in t.split("\n") if "|" not in x and "rights" not in x.lower()), h) for d, t, h in rows]
    want = [w for w in want if w[0] != 101]  # the menu 30 times over: fails the base rule
    docs = frame(spark, rows).withColumn("n_chars", F.length("text"))
    got = quality.keep_good(docs, length="n_chars")
    assert got.dtypes == docs.dtypes
    got = got.collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in got)
    stage = corpus_pipeline.quality_rules(spark, docs, SF).collect()
    assert sorted((r.text for r in stage)) == sorted(w[1] for w in want)


def test_repeated_words_is_exact():
    rng = random.Random(5)
    for size, letters in ((300, 3), (400, 12), (6000, 5000)):
        words = [b"%d" % rng.randrange(letters) for _ in range(size)] * 2
        windows = defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i:i + 5])].append(i)
        want = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
        assert quality.repeated_words(words) == len(want)


# --- the pipeline -------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = documents(spark)
    seen = []
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF)
        if name != "bpe_encoding":
            assert out.dtypes == docs.dtypes
        out.write.parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/test-{random.random()}")
        docs = spark.read.parquet(path)
        seen.append((name, docs.collect()))
    stages = dict(seen)
    # quality rules: the brute-force verdicts
    kept = {r[0] for r in brute_quality(before) if r[7]}
    assert {r.doc_id for r in stages["quality_rules"]} == kept
    rows = [tuple(r)[:2] + (r.source,) for r in stages["quality_rules"]]
    assert sorted(rows) == sorted(r for r in before if r[0] in kept)
    # near-duplicates: the smallest doc_id of each component
    assert {r.doc_id for r in stages["simhash_dedup"]} == {c for _, _, c in brute_simhash(rows)}
    text = dict((r[0], r[1]) for r in rows)
    # secrets: none is left, other texts are unchanged
    assert {r.doc_id for r in stages["secret_scans"]} == {r.doc_id for r in stages["simhash_dedup"]}
    for r in stages["secret_scans"]:
        assert not any(plain_secrets(r.text)) and r.n_chars == len(r.text)
        assert r.text == text[r.doc_id] or any(plain_secrets(text[r.doc_id]))
    # mixing: the words taken meet the targets
    own = [(r.doc_id, r.text, r.source) for r in stages["secret_scans"]]
    taken = defaultdict(int)
    for r in stages["source_mixing"]:
        taken[r.doc_id] += len(r.text.encode().split())
    sizes = {d: len(t.encode().split()) for d, t, _ in own}
    by_source = defaultdict(int)
    for d, _, s in own:
        by_source[s] += sizes[d]

    class Row:
        def __init__(self, d, s):
            self.doc_id, self.source, self.size, self.taken = d, s, sizes[d], taken[d]
            self.source_size = by_source[s]

    from tests.llm.test_native import fill
    sources = sorted(by_source)
    target = fill(by_source, {s: [3, 1, 2][i % 3] for i, s in enumerate(sources)})
    for s in sources:
        assert abs(sum(taken[d] for d, _, x in own if x == s) - target[s]) <= 2
    assert all(taken[d] <= 2 * sizes[d] for d in sizes)
    # token ids: the library's
    tok = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    want = sorted((r.doc_id, e.ids) for r, e in zip(stages["source_mixing"], tok.encode_batch(
        [r.text for r in stages["source_mixing"]], add_special_tokens=False)))
    assert sorted((r.doc_id, list(r.ids)) for r in stages["bpe_encoding"]) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in stages["bpe_encoding"])


def test_pipeline_odd_rows(spark):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(40))
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, row int"
    rows = [(1, text, "en", "a", len(text), "x", 1), (1, text, "en", "a", len(text), "x", 1), (2, None, None, None, None, None, None),
            (None, text + " token=123456789", "en", None, None, "", 0), (3, "", "en", "b", 0, "", 0)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, SF)
        got = docs.collect()
        assert {r.doc_id for r in got} <= {1, None} and bool(got) == bool(data)
