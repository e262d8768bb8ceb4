"""Training-data operators against brute force and hand-made cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessellon.llm import groups, leak, mix, sentences, survivor


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


# --- groups ----------------------------------------------------------------------------------------
def union_find(links, members):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    for m in members:
        if m is not None:
            find(m)
    return {x: find(x) for x in root}


def graph(kind):
    r = random.Random(kind)
    if kind == "path":
        p = [f"n{i:04d}" for i in range(400)]
        r.shuffle(p)
        return list(zip(p, p[1:]))
    if kind == "star":
        return [("hub", f"l{i}") if i % 2 else (f"l{i}", "hub") for i in range(300)]
    n = 250
    return [(f"v{r.randrange(n)}", f"v{r.randrange(n)}") for _ in range(200)] + [("v1", "v1"), (None, "v2"), ("lone", None), (None, None), ("v3", "v4"), ("v4", "v3"), ("v3", "v4")]


@pytest.mark.parametrize("kind,degree,forest", [("path", 50_000, 0), ("path", 50_000, 100), ("star", 20, 0), ("star", 20, 10_000), ("random", 3, 0), ("random", 3, 20)])
def test_groups(spark, scratch, kind, degree, forest):
    links, members = graph(kind), ["alone", "v1", None, "alone"]
    df = spark.createDataFrame([(a, b, "x") for a, b in links], "left string, right string, root string")
    got = rows(groups.groups(df, spark.createDataFrame([(m,) for m in members], "member string"), scratch, degree, forest), "member", "group_id")
    assert got == sorted(union_find(links, members).items(), key=repr)


def test_groups_empty(spark, scratch):
    none = spark.createDataFrame([], "left string, right string")
    assert groups.groups(none, spark.createDataFrame([], "member string"), scratch).count() == 0


def test_clusters_are_connected(spark):
    """The growth of one level: every cluster is connected through its own members, and each vertex lies in the cluster that reaches it first."""
    r = random.Random(5)
    edges = {tuple(sorted(r.sample(range(120), 2))) for _ in range(150)}
    df = spark.createDataFrame(list(edges), "a long, b long")
    got = dict(rows(groups._grow(df, groups._ends(df), 0), "v", "c"))
    inside = union_find([(a, b) for a, b in edges if got[a] == got[b]], got)
    assert len({inside[v] for v in got}) == len(set(got.values())) < len(got)
    best = {x["v"]: (x["s"], x["v"]) for x in groups._ends(df).select("v", groups._shift(F.col("v"), 0).alias("s")).collect()}
    for _ in range(groups.MAX_SHIFT):
        sent = [(v, best[u]) for a, b in edges for u, v in ((a, b), (b, a)) if best[u][0]]
        for v, (s, c) in sent:
            best[v] = max(best[v], (s - 1, c))
    assert got == {v: c for v, (_, c) in best.items()}


# --- survivors -------------------------------------------------------------------------------------
def test_pick(spark):
    df = spark.createDataFrame([("a", 1, 5, None), ("a", 2, 5, 3), ("a", 3, 9, 1), ("b", 4, None, None)], "k string, id int, trust int, day int")
    got = df.groupBy("k").agg(survivor.pick(F.col("trust").isNotNull() & (F.col("trust") < 9), F.col("id"), F.col("trust"), F.col("day")).alias("best"))
    assert rows(got, "k", "best") == [("a", 2), ("b", None)]


def test_fusion_finds_truth_despite_copies(spark, scratch):
    """Two sources copy a bad one; four independent ones are mostly right. Plain voting errs more than fusion."""
    r = random.Random(3)
    claims, truth = [], {}
    for i in range(150):
        truth[i] = f"t{i}"
        bad = truth[i] if r.random() < 0.5 else f"f{i}-{r.randrange(10)}"
        for s in ("bad", "copy1", "copy2"):
            claims.append((i, s, bad if s == "bad" or r.random() < 0.95 else truth[i]))
        for s in ("good1", "good2", "good3", "good4"):
            claims.append((i, s, truth[i] if r.random() < 0.8 else f"f{i}-{r.randrange(10)}"))
    df = spark.createDataFrame([*claims, *claims[:50], (None, "s", "v"), (1, None, "v"), (1, "s", None)], "item int, source string, value string")
    out = survivor.fuse(df, scratch, rounds=4)
    got = {x["item"]: x for x in out.collect()}
    assert len(got) == 150 and all(0 < x["posterior"] <= 1.000001 for x in got.values())
    right = sum(got[i]["value"] == truth[i] for i in truth)
    votes = defaultdict(Counter)
    for i, _, v in claims:
        votes[i][v] += 1
    voted = sum(max(sorted(votes[i]), key=lambda v: votes[i][v]) == truth[i] for i in truth)
    assert right >= 0.9 * 150 and right > voted


def test_fusion_ties_and_empty(spark, scratch):
    df = spark.createDataFrame([("x", "s1", "b"), ("x", "s2", "a")], "item string, source string, value string")
    assert survivor.fuse(df, scratch, rounds=1).first()["value"] == "a"
    assert survivor.fuse(df.limit(0), scratch).count() == 0


# --- leaks -----------------------------------------------------------------------------------------
def test_tokens():
    assert leak.tokens("Café <b>wo</b>rd *x* _y_ l'été zero​width so\xadft 3,5") == "cafe word x y l ete zerowidth soft 3 5".split()
    assert leak.tokens("a<br>b") == ["a", "b"] and leak.tokens(None) == [] and leak.tokens("你 好，a1", chars=True) == list("你好a1")


@pytest.mark.parametrize("unit", [leak.WORDS, leak.CHARS])
def test_leaks(spark, scratch, unit):
    r = random.Random(1)
    word = (lambda: r.choice("abcdefgh")) if not unit.chars else (lambda: chr(0x4E00 + r.randrange(6)))
    sep = "" if unit.chars else " "
    items = [(i, sep.join(word() for _ in range(40)), "x") for i in range(12)] + [(50, None, ""), (51, "short", ""), (52, "", "")]
    docs = []
    for i in range(60):
        a = [word() for _ in range(r.randrange(0, 60))]
        toks = items[r.randrange(12)][1]
        toks = list(toks) if unit.chars else toks.split(" ")
        n, s = unit.span + r.choice([-1, 0, 0, 3]), r.randrange(0, 10)
        docs.append((i, sep.join([*a, *toks[s : s + n], *a]), 1))
    docs += [(100, None, 1), (101, " ", 1), (102, items[0][1], 1), (103, items[0][1] * 3, 1), (104, "z " * 100_000, 1)]
    want = set()
    for d, text, _ in docs:
        t = leak.tokens(text, unit.chars)
        grams = {tuple(t[k : k + unit.span]) for k in range(len(t) - unit.span + 1)}
        for i, x, _ in items:
            q = leak.tokens(x, unit.chars)
            if any(tuple(q[k : k + unit.span]) in grams for k in range(len(q) - unit.span + 1)):
                want.add((d, i))
    a, b = spark.createDataFrame(docs, "doc_id long, text string, pos int"), spark.createDataFrame(items, "item_id long, item_text string, text string")
    got = leak.leaks(a, "doc_id", "text", b, "item_id", "item_text", scratch, F.lit(unit.chars))
    assert rows(got, "doc_id", "item_id") == sorted(want, key=repr) and len(want) > 30
    assert leak.leaks(a.limit(0), "doc_id", "text", b, "item_id", "item_text", scratch, F.lit(unit.chars)).count() == 0


@pytest.mark.parametrize("unit", [leak.WORDS, leak.CHARS])
def test_leaks_with_one_token_replaced(spark, scratch, unit):
    r = random.Random(5)
    fresh = iter(range(0x4E00, 0x9000))
    word = (lambda: chr(next(fresh))) if unit.chars else (lambda: f"w{r.randrange(10**9)}")
    sep, docs, items = "" if unit.chars else " ", [], []
    for i in range(40):
        before, after = r.randrange(unit.gram, unit.span), unit.span + r.randrange(6)
        toks = [word() for _ in range(before + 1 + after)]
        items.append((i, sep.join(toks)))
        docs.append((i, sep.join([word(), *toks[:before], word(), *toks[before + 1 :]]), before + 2, after))
        # two runs on one diagonal: the longer is the second
        toks = [word() for _ in range(2 * unit.span + 4)]
        items.append((100 + i, sep.join(toks)))
        docs.append((100 + i, sep.join([*toks[: unit.span], word(), *toks[unit.span + 1 :]]), unit.span + 1, unit.span + 3))
    a = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, item_text string")
    got = leak.leaks(a, "doc_id", "text", b, "item_id", "item_text", scratch, F.lit(unit.chars))
    assert rows(got, "doc_id", "item_id", "at", "shared") == sorted(((d, d, at, n) for d, _, at, n in docs), key=repr)


def test_leaks_of_repeated_keys_and_nulls(spark, scratch):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "nothing here", "x"), (1, f"a b {item}", "x"), (1, item, "y"), (None, item, "x"), (2, None, None), (3, item, None), (3, item, None), (4, "", None)]
    a = spark.createDataFrame(docs, "doc_id long, text string, item string")
    b = spark.createDataFrame([(7, item, 0), (None, item, 0), (8, None, 0), (9, item, 1)], "item_id int, item_text string, hits int")
    got = leak.leaks(a, "doc_id", "text", b, "item_id", "item_text", scratch)
    assert rows(got, "doc_id", "item_id", "shared", "at") == [(d, i, 30, 0) for d in (1, 3) for i in (7, 9)]
    assert leak.leaks(a, "doc_id", "text", b.limit(0), "item_id", "item_text", scratch).count() == 0


def test_too_many_sources(spark, scratch):
    many = spark.range(survivor.MAX_SOURCES + 1).selectExpr("id % 7 AS item", "string(id) AS source", "'v' AS value")
    with pytest.raises(ValueError):
        survivor.fuse(many, scratch)


# --- mixing ----------------------------------------------------------------------------------------
def test_quotas():
    q = mix.quotas({"a": 1000, "b": 50}, {"a": 0.5, "b": 0.5}, {"a": 1, "b": 4}, 1000)
    assert q == {"a": 800, "b": 200}
    assert mix.quotas({"a": 10}, {"a": 0.5, "gone": 0.5}, {"a": 3, "gone": 9}, 100) == {"a": 30, "gone": 0}
    assert mix.quotas({}, {"a": 1.0}, {"a": 2}, 10) == {"a": 0}


def test_schedule_stays_within_a_block():
    blocks = {"a": 57, "b": 31, "c": 12, "d": 1, "e": 0}
    order = list(mix.schedule(blocks))
    total, done = sum(blocks.values()), Counter()
    assert Counter(s for s, _ in order) == Counter({k: v for k, v in blocks.items() if v})
    for t, (s, k) in enumerate(order, 1):
        assert k == done[s]
        done[s] += 1
        for x, n in blocks.items():
            assert abs(done[x] - n * t / total) < 1


def test_mix(spark, scratch):
    r = random.Random(2)
    docs = [(i, "big" if i % 10 else "small", r.randrange(1, 400)) for i in range(3000)] + [(9001, "none", 5), (None, "big", 5), (9002, "big", 0), (9003, None, 4)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "id long, source string, tokens long, slot int")
    goals = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 5), ("gone", 0.0, 3)], "source string, target_share double, max_repeats int")
    mixture, report = mix.mix(df, goals, scratch, block_tokens=500)
    rep = {x["source"]: x for x in report.collect()}
    assert abs(rep["small"]["actual_share"] - 0.3) < 0.01 and rep["gone"]["used"] == 0
    uses = Counter((x["id"], x["pass_no"]) for x in mixture.collect())
    assert max(uses.values()) == 1 and all(p < 5 for _, p in uses)
    assert {x["id"] for x in mixture.where("source = 'big'").collect()} <= {d[0] for d in docs if d[1] == "big"}
    empty, rep0 = mix.mix(df.limit(0), goals, scratch)
    assert empty.count() == 0 and all(x["actual_share"] == 0 for x in rep0.collect())


def test_pieces_change_no_order(spark, scratch, monkeypatch):
    docs = [(i, f"s{i % 3}", 1 + i % 50) for i in range(2000)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "id long, source string, tokens long, before int")
    goals = spark.createDataFrame([("s0", 0.5, 2), ("s1", 0.3, 2), ("s2", 0.2, 2)], "source string, target_share double, max_repeats int")
    got = []
    for size in (50_000, 100):
        monkeypatch.setattr(mix, "PIECE_DOCS", size)
        got.append(rows(mix.mix(df, goals, scratch, block_tokens=300)[0], "slot", "source", "offset", "pass_no", "id"))
    assert got[0] == got[1] and len(got[0]) > 1500


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world", " Term-Definitions "), (2, "", "a"), (3, None, "a"), (4, "<|endoftext|>", None)], "id long, text string, source string")
    got = {x["id"]: (x["source"], x["tokens"]) for x in mix.token_counts(df, "id", "text", mix.source_name("source")).collect()}
    assert got[1] == ("term_definitions", 2) and got[2] == ("a", 0) and 3 not in got and got[4][1] > 1


# --- sentences -------------------------------------------------------------------------------------
CASES = [
    ("One. Two! Three? Four", ["One.", "Two!", "Three?", "Four"]),
    ("Dr. A. B. Smith saw fig. 3 (see no. 4). eGF-like X fell by 3.5 mg, i.e. little.", ["Dr. A. B. Smith saw fig. 3 (see no. 4).", "eGF-like X fell by 3.5 mg, i.e. little."]),
    ("They used salts, etc. before it. At 8 a.m. and 6 p.m. we met.", ["They used salts, etc. before it.", "At 8 a.m. and 6 p.m. we met."]),
    ('The leaflet says "Store cold. Do not freeze." and stops. He wrote: "Keep it. Drop it." Then it ended.', ['The leaflet says "Store cold. Do not freeze." and stops.', 'He wrote: "Keep it. Drop it."', "Then it ended."]),
    ('"Which one survives?" asked one curator. Yes.', ['"Which one survives?" asked one curator.', "Yes."]),
    ("pH was high. (The file is in Sect. 3 of the book.) It took 5.5 h. Line 10... then on.", ["pH was high.", "(The file is in Sect. 3 of the book.)", "It took 5.5 h.", "Line 10... then on."]),
    ("1. Scope\n\nText here\n\n\nNo mark", ["1. Scope", "Text here", "No mark"]),
    ("See https://a.example/v1.2/x.html now. The file a.6.1.tsv is big.The next one.", ["See https://a.example/v1.2/x.html now.", "The file a.6.1.tsv is big.", "The next one."]),
    ("Wait, wrong?! What now?", ["Wait, wrong?!", "What now?"]),
    ("Das gilt seit dem 17. Release. Die 2. Fassung steht in Liste 84. Am 13. März, z. B. in v2, u. a. wegen Xylol. „Das ist keins“, schrieb er. Es steht: „Nicht lagern. Schützen.“ Ende.", ["Das gilt seit dem 17. Release.", "Die 2. Fassung steht in Liste 84.", "Am 13. März, z. B. in v2, u. a. wegen Xylol.", "„Das ist keins“, schrieb er.", "Es steht: „Nicht lagern. Schützen.“", "Ende."]),
    ("La notice précise : « Conserver à 5 °C. Ne pas congeler. » M. Dupont a relu. Quelle surprise !", ["La notice précise : « Conserver à 5 °C. Ne pas congeler. »", "M. Dupont a relu.", "Quelle surprise !"]),
    ("Dice: «Guardar a 2 °C. No congelar». ¡No mezcle! Los EE. UU. enviaron 3.", ["Dice: «Guardar a 2 °C. No congelar».", "¡No mezcle!", "Los EE. UU. enviaron 3."]),
    ("Список верен, т. е. версия 2. См. рис. 3. А. Б. Монистол удалил в 2006 г. из списка.", ["Список верен, т. е. версия 2.", "См. рис. 3.", "А. Б. Монистол удалил в 2006 г. из списка."]),
    ("Ανήκει στην ίδια ομάδα; Η έκδοση προσθέτει ονόματα κ.λπ. στον πίνακα. Ο Δρ. Χ ήρθε.", ["Ανήκει στην ίδια ομάδα;", "Η έκδοση προσθέτει ονόματα κ.λπ. στον πίνακα.", "Ο Δρ. Χ ήρθε."]),
    ("说明书写道：“低于84度保存。不要冷冻。”该映射早于它。编辑说“先合并，再检查。”然后关闭了。质量为3.5kDa……但不稳定。", ["说明书写道：“低于84度保存。不要冷冻。”", "该映射早于它。", "编辑说“先合并，再检查。”然后关闭了。", "质量为3.5kDa……但不稳定。"]),
    ("「どの名前。」と尋ねた。添付文書には「保存。凍結しないこと。」と書かれている。これか？はい！", ["「どの名前。」と尋ねた。", "添付文書には「保存。凍結しないこと。」と書かれている。", "これか？", "はい！"]),
    ("पर्चे पर लिखा है, \"नीचे रखें। जमाएँ नहीं।\" रोगी को 4.5 मि.ग्रा. की मात्रा। डॉ. क ने देखा।", ["पर्चे पर लिखा है, \"नीचे रखें। जमाएँ नहीं।\"", "रोगी को 4.5 मि.ग्रा. की मात्रा।", "डॉ. क ने देखा।"]),
    ("تقول النشرة: «يحفظ دون 5 درجة. لا يجمد». هل ينتمي؟ راجع د. زوكي القائمة.", ["تقول النشرة: «يحفظ دون 5 درجة. لا يجمد».", "هل ينتمي؟", "راجع د. زوكي القائمة."]),
    ("ยานี้ไม่ควรใช้  ดร.เวซาตรวจ2.5มก.\nโรคพบน้อย", ["ยานี้ไม่ควรใช้", "ดร.เวซาตรวจ2.5มก.", "โรคพบน้อย"]),
    ("the leaflet says \"store it. do not freeze.\" and no more. the end came. see fig. 3 now.", ["the leaflet says \"store it. do not freeze.\" and no more.", "the end came.", "see fig. 3 now."]),
    ("An open \"quote never ends. The next one does.", ["An open \"quote never ends.", "The next one does."]),
    ("<b>Bold end.</b> *Next one.* Last ", ["<b>Bold end.</b>", "*Next one.*", "Last"]),
]


@pytest.mark.parametrize("text,want", CASES)
def test_sentences(text, want):
    assert [text[b:e] for b, e in sentences.sentences(text)] == want


def test_no_sentences():
    assert [sentences.sentences(x) for x in (None, "", " \n\t ", "\n\n")] == [[]] * 4


def test_prefix_scan():
    """Composed functions lead where reading event by event does, from every state and number of open brackets."""
    r = np.random.default_rng(0)
    found = [[(int(e), 0) for e in r.choice([sentences._UNIT, sentences._IN, *sentences._OUT, *r.integers(0, len(sentences.EVENTS), 4)], 9, p=[0.04, 0.3, 0.15, 0.15, 0.09, 0.09, 0.09, 0.09])] for _ in range(13)]
    scan = sentences.compose([sentences.transition(f) for f in found])
    for s in range(len(sentences.DELTA)):
        for start in (0, 1, 5):
            at, depth = s, start
            for f, (to, a, b) in zip(found, scan):
                for e, _ in f:
                    at = int(sentences.DELTA[at, e])
                    depth = 0 if e == sentences._UNIT else depth + 1 if e == sentences._IN else max(0, depth - 1) if e in sentences._OUT else depth
                assert to[s] == at and depth == (b if a is None else max(start + a, b))


@pytest.mark.parametrize("n", [100, 3000, 30_000])
def test_quotations_and_brackets_of_any_size(n):
    """No distance and no depth makes a quotation or bracket plain text."""
    inside = "One thing. " * (n // 11)
    assert len(sentences.sentences(f'He said "{inside}end" and left. Next.')) == 2
    assert len(sentences.sentences(f"It is ({inside}end) so. Next.")) == 2
    deep = "(" * (n // 100) + "a. B. C" + ")" * (n // 100)
    assert len(sentences.sentences(f"Deep {deep} here. Next one.")) == 2
    assert len(sentences.sentences(f'An open "quote {inside}')) > n // 11 - 2


def test_scripts_with_marks_of_their_own():
    for text in ("یہ پہلا ہے۔ یہ دوسرا ہے۔", "Սա առաջինն է։ Սա երկրորդն է։", "ይህ አንድ ነው። ይህ ሁለት ነው።", "ဒါကတစ်ပါ။ ဒါကနှစ်ပါ။", "នេះជាទីមួយ។ នេះជាទីពីរ។"):
        assert len(sentences.sentences(text)) == 2


def test_chunks_change_nothing(spark):
    r = random.Random(4)
    parts = [t for t, _ in CASES if "\n\n" not in t and not any("฀" <= c <= "๿" for c in t) and t != t.lower()]
    text = "".join(r.choice(parts) + r.choice([" ", "\n", "\n\n", "  "]) for _ in range(400))
    df = spark.createDataFrame([(1, text, 0), (2, "Short one. Two.", 0), (3, None, 0), (4, "x" * 9000, 0)], "doc_id long, text string, sent_no int")
    whole = rows(sentences.split_sentences(df, "doc_id", "text"), "doc_id", "sent_no", "begin_pos", "end_pos")
    for size in (40, 333, 5000):
        assert sentences.sentences(text, size) == [r[2:] for r in sorted(whole) if r[0] == 1]
    for size in (700, 5000):
        assert rows(sentences.split_sentences(df, "doc_id", "text", size), "doc_id", "sent_no", "begin_pos", "end_pos") == whole
    assert sentences.split_sentences(df.limit(0), "doc_id", "text").count() == 0
