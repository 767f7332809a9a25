"""Every operator on small tables: brute force or exact round trips, nulls, empty and long texts, ties, repeats, clashes."""

import base64
import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnwatch.llm import bpe, chat, decontaminate, html_extract, langid, lstm_crf, pii, quality, queries, secret_scan

SF = "/root/testdata/sf0.001"
EXTRA = "n_words long, kept string, spans int, token_ids string, score string, words int, id int, t int"
ODD = [None, "", " \n\t", "a", "Ä€😀 </s>[INST]", "x " * 3000, "same text here", "same text here"]


def odd(spark, extra="doc_id long, text string, lang string, " + EXTRA):
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, 1, "k", 2, "b", "s", 3, 4, 5) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, extra)


# --- 1 chat ------------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "\\</s>", "\\\\[INST]", "ends in \\", "<<SYS>> x <</SYS>>", "[ROLE] r [/ROLE]", "", None, "a\nb </s>", "<s> </s>\n[INST] "]


def conversations():
    rng = random.Random(3)
    rows = []
    for conv in range(40):
        n = rng.choice([1, 2, 5, 12, 150])
        roles = (["system"] if conv % 3 == 0 else []) + [rng.choice(["user", "assistant", "assistant", "system", "tool [/ROLE] x", None]) for _ in range(n)]
        for turn, role in enumerate(roles):
            text = rng.choice(TRICKY) if rng.random() < 0.3 else " ".join(rng.choices(["ab", "cd", "ef!"], k=rng.randrange(0, 60)))
            rows.append((conv, turn if conv != 7 else 1, role, text, "x", 1))
    rows += [(100, 0, "system", "only me", "x", 1), (None, 0, "user", "null conversation", "x", 1), (101, None, "assistant", "t " * 900, "x", 1)]
    return rows


def test_chat_round_trip_budget_and_mask(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string, n_turns int").repartition(3)
    made = chat.turns_of(chat.windows(df, budget=120, history=30)).orderBy("conv_id", "window").collect()
    by = collections.defaultdict(list)
    for r in made:
        by[r.conv_id].append(r)
    want = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(by) == set(want)
    for conv, turns in want.items():
        turns = [t[2:] for t in sorted(turns)]
        assert [(t.role, t.text) for r in by[conv] for t in r.turns] == turns
        assert [x for r in by[conv] for x in r.targets] == [t for role, t in turns if role == "assistant"]
        for k, r in enumerate(by[conv]):
            assert r.over_budget == (r.n_tokens > 120)
            if r.over_budget and turns[0][0] != "system":
                assert r.n_turns == 1  # one turn that is too large by itself
            if turns[0][0] == "system" and len(turns) > 1:  # the system turn opens every window
                assert r.formatted.startswith("<<SYS>> ")


def test_chat_query_equals_plain_digests(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    want = collections.defaultdict(list, {-1: [(0, "user", queries.PROBE), (1, "assistant", queries.PROBE)]})
    for r in rows:
        want[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    got = queries.op1_chat_windows(spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        c = sorted(want[r.conv_id])
        loss = "".join(t for _, role, t in c if role == "assistant")
        assert r.n_turns == len(c) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{q}\n{t}\n" for _, q, t in c).encode()).hexdigest()


# --- 2 language --------------------------------------------------------------

def test_language_counts_and_held_out_accuracy(spark):
    texts = ["Ab c!", "", "123 ...", "xyz Añ", "a", "İx"]
    got = {}
    for start, grams, counts in langid.gram_counts(texts):
        for i, row in enumerate(counts):
            got[start + i] = {tuple(map(int, grams[k])): int(row[k]) for k in np.flatnonzero(row)}
    for i, t in enumerate(texts):
        s = re.sub("\0+", "\0", "\0" + "".join(c if c.isalpha() else "\0" for c in t.lower()) + "\0")
        assert got.get(i, {}) == dict(collections.Counter(tuple(map(ord, s[j:j + 3])) for j in range(len(s) - 2)))
    rows = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows if r.lang]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    df = odd(spark)
    model = langid.train(df)
    got = langid.predict(df, model).collect()
    assert len(got) == len(ODD) and {r.lang_pred for r in got} <= {"en", "und"}
    assert sum(r.lang_pred == "und" for r in got) == 3 and got[0].score == 0
    empty = langid.train(df.limit(0))
    assert empty[0] == [] and {r.lang_pred for r in langid.predict(df, empty).collect()} == {"und"}


# --- 3 quality ---------------------------------------------------------------

def plain_measures(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", t or "")
    c = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover)


def test_quality_measures(spark):
    rng = random.Random(1)
    texts = [*ODD, *(" ".join(rng.choices("ab", k=rng.randrange(5, 60))) for _ in range(40)), "a#\n\na#\n b \n b \n", "é$ \x0b\x0c x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    for r in quality.measures(df).collect():
        t = texts[r.id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(t), t
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for p in (0.01, 0.2) for n in (1, 7, 300, 5000) for k in (0, 1, 3, 20)]
    for p in (0.01, 0.2):
        mine = [(n, k) for n, k, q in cases if q == p]
        df = spark.createDataFrame(mine, "n long, k long").select("n", "k", quality.lower_tail(F.col("n"), F.col("k"), p).alias("x"))
        for r in df.collect():
            exact = 1.0 if r.k >= r.n * p else sum(math.comb(r.n, i) * p ** i * (1 - p) ** (r.n - i) for i in range(r.k + 1))
            assert math.isclose(r.x, exact, rel_tol=1e-9)


def test_cutoffs_hold_their_promise(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(3000):
        good = rng.random() < 0.8
        share = rng.random() * (0.08 if good else 2)  # symbols a word
        rows.append((i, " ".join(f"w{rng.randrange(10**6)}" + "#" * (rng.random() < share % 1) + "#" * int(share) for _ in range(30)), "de" if i % 3 else None))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = spark.createDataFrame(labels + [(5, None), (10**9, 1)], "doc_id long, quality int")
    got = quality.verdicts(docs, labelled).collect()
    good = dict(labels)
    lost = sum(not r.kept and not r.base_failed and good[r.id] for r in got) / sum(good.values())
    caught = sum(not r.kept and not good[r.id] for r in got) / (len(good) - sum(good.values()))
    assert lost <= quality.ALPHA and caught > 0.5
    unlabelled = quality.verdicts(docs, labelled.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in unlabelled)
    kept = quality.keep(docs, labelled)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.id for r in got if r.kept}
    assert quality.verdicts(odd(spark), labelled).count() == len(ODD) and quality.verdicts(docs.limit(0), labelled).count() == 0


def test_cutoffs_of_small_strata(spark):
    """Strata of 300 good labels get cutoffs, and a step that loses more than alpha passes no more often than it may."""
    rng, strata = random.Random(12), 200
    rows, labels = [], []
    for stratum in range(strata):
        for i in range(340):
            good, x = i < 300, rng.random()
            # of the good ones 1% go at 50 symbols in 100 words and another 7% at 25; a rule that catches no bad one takes them all
            symbols = (60 if x < 0.01 else 30 if x < 0.08 else 0) if good else 300
            rows.append((len(rows), f"s{stratum}", 100, 500, symbols, 0, 400 if good else 0, 3, 0, 0))
            labels.append((rows[-1][0], int(good)))
    measured = spark.createDataFrame(rows, "id long, stratum string, " + ", ".join(f"{c} long" for c in quality.COUNTS))
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.cutoffs(measured, labelled, delta=0.05 * strata).collect()  # 0.05 a stratum
    assert {r.rule for r in got} == {"symbols"} and len(got) > 0.9 * strata
    assert sum(r.percent <= 25 for r in got) <= 0.08 * strata
    few = quality.cutoffs(measured.where("stratum = 's0'").where("id < 50 or id >= 300"), labelled)
    assert few.count() == 0  # 0.95 ** 50 is over 0.05, so 50 good labels prove nothing


# --- 4 pages -----------------------------------------------------------------

FRAME = "<html><body><header><h1>Site</h1></header><div class=x><b>News of the site</b></div>{}<div><p>Buy our things</p></div></body></html>"


def test_templates_are_cut_and_articles_kept(spark, monkeypatch):
    pages = [(i, f"http://a.example/{i}", FRAME.format(f"<div><p>Own text number {i}<p>and &amp; more {i}</div>")) for i in range(12)]
    pages += [(100 + i, "http://b.example/x", FRAME.format("<div><p>Posted again</p></div>")) for i in range(9)]
    pages += [(200, None, None), (201, "nonsense", ""), (202, "http://b.example/", "<p>alone &lt;b&gt;</p><script>no</script>"),
              (203, "http://b.example/y", "<div class='a comments'>they said</div><article><header>Title</header>x<br>y <aside>z</aside>"
                                          "<div id=reader-comments>me too</div><form>f</form>\n<p>  e\u00a0nd</article><footer>f</footer>"),
              (204, "//", "<" * 50 + "<p" * 50), (205, "http://c/", "<div>" * 3000 + "deep"), (206, "http://c/", "a" * 200_000)]
    df = spark.createDataFrame([(*p, 1, "q") for p in pages], "page_id long, url string, html string, text int, host string").repartition(4)
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert len(got) == len(pages)
    for i in range(12):
        assert got[i] == f"Own text number {i}\nand & more {i}"
    # a page posted again and again is one page of its host, so nothing recurs there
    assert got[100] == got[108] == "News of the site\nPosted again\nBuy our things"
    assert got[200] == got[201] == "" and got[202] == "alone <b>" and got[203] == "Title\nx y\ne nd" and got[205] == "deep" and len(got[206]) == 200_000
    assert html_extract.extract(df.limit(0)).count() == 0
    monkeypatch.setattr(html_extract, "SENT", -1)  # too many templates to send: the join
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == got


def test_sections_of_a_large_host_are_cut(spark, monkeypatch):
    pages = []
    for i in range(1500):  # a box on 60 pages of a host of 1,500: 4%
        box = "<div><p>Box of the section</p></div>" if i < 60 else ""
        pages.append((i, f"http://a.example/{i}", f"<body>{box}<div><p>Own text number {i}</p></div></body>"))
    df = spark.createDataFrame(pages + [(i, "http://b.example/", "<p>alone</p>") for i in range(1500, 1520)],
                               "page_id long, url string, html string").repartition(4)
    want = {i: f"Own text number {i}" for i in range(1500)} | dict.fromkeys(range(1500, 1520), "alone")
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == want
    monkeypatch.setattr(html_extract, "SENT", 0)
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == want


def test_names_and_forms_of_an_article():
    def text(source):
        root = html_extract.Tree(source).root
        html_extract.hash_subtrees(root)
        return html_extract.main_text(root, frozenset())

    assert text('<article><header class="entry-header"><h1>Head</h1></header><section class="social-policy"><p>a</p></section>'
                '<div class="share-capital">b</div><div class="share">c</div><div class="x reader-comments">d</div>'
                '<div class="ad">e</div></article>') == "Head\na\nb"
    assert text("<body><form><div><p>The whole page is in a form</p></div></form><p>end</p></body>") == "The whole page is in a form\nend"
    assert text("<form><article><p>own text</p></article></form>") == "own text"
    assert text("<p>A page with a small form after it</p><form>Mail <input></form>") == "A page with a small form after it"


# --- 6 BPE -------------------------------------------------------------------

def test_bpe_equals_the_library(spark):
    path = queries.tokenizer_path()
    reference = Tokenizer.from_file(path)
    rng = random.Random(7)
    letters = [chr(c) for c in [*range(0, 300), 0x2028, 0x3000, 0x1680, 0x200B, 0xFEFF, 0x4E00, 0x1F600, 0x300, 0x180E, 0x85]]
    texts = [*ODD, "a<|endoftext|>b <|endoftext|>", "A" * 4000, " " * 999, "don't I'LL", *("".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(300))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("token_ids", F.lit(1)).repartition(3)
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, path), path).collect()}
    for i, t in enumerate(texts):
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].token_ids, "<u4").tolist() == ids and got[i].decoded == reference.decode(ids, skip_special_tokens=False)
    model = bpe.ForcedBoundaryBpe(open(path, encoding="utf-8").read())
    assert b"".join(model.cut("ab€zé".encode())) == "ab€zé".encode() and model.decode(np.array([10**6, 64], "<u4").tobytes()) == "a"
    assert bpe.encode(odd(spark), path).count() == len(ODD) and bpe.encode(df.limit(0), path).count() == 0


# --- 8 benchmark -------------------------------------------------------------

def test_decontamination_equals_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdef", k=3))
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 40)))) for i in range(12)] + [(90, None), (91, "x y"), (92, "")]
    docs = []
    for i in range(80):
        w = [word() for _ in range(rng.randrange(0, 60))]
        if i % 2:
            item = items[rng.randrange(12)][1].split()
            for _ in range(rng.randrange(0, len(item) // 5 + 3)):
                k = rng.randrange(len(item))
                item[k:k + 1] = rng.choice([[], [word()], [word(), item[k]]])
                item = item or [word()]
            at = rng.randrange(len(w) + 1)
            w[at:at] = item
        docs.append((i, " ".join(w).upper() if i % 7 == 0 else "\n ".join(w)))
    docs += [(None, None), (81, ""), (82, items[0][1]), (82, items[0][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, distance int").repartition(3)
    bench = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")

    def nearest(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    want = collections.Counter()
    for i, t in docs:
        for k, p in items:
            p = (p or "").split()
            d = nearest(p, (t or "").lower().split())
            if len(p) >= decontaminate.LEAST and d <= len(p) // decontaminate.TOLERANCE:
                want[i, k, d] += 1
    got = decontaminate.matches(df, bench).collect()
    assert collections.Counter((r.doc_id, r.item_id, r.distance) for r in got) == want and len(want) > 20
    dirty = {i for i, _, _ in want}
    clean = decontaminate.clean(df, bench)
    assert clean.columns == df.columns and sorted(r.doc_id or -1 for r in clean.collect()) == sorted(i or -1 for i, _ in docs if i not in dirty)
    assert decontaminate.matches(df.limit(0), bench).count() == 0 and decontaminate.matches(df, bench.limit(0)).count() == 0


# --- 9 personal data ---------------------------------------------------------

def plain_pii(t):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                           r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 16 <= len(d) <= 19 and pii.luhn(d) or k == 3 and 8 <= len(d) <= 15:
                out.append((k, m.start(), m.end()))
    return out


def test_pii_patterns_equal_plain_regexes():
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choices(rng.choice(["a@.1 -+(", "0123456789. -+", "12.3", "a.@b-_%", "+1 ()4.-9"]), k=rng.randrange(0, 44)))
        assert pii.pattern_spans(t) == plain_pii(t)
    assert pii.pattern_spans("1" * 200_000 + "@" * 1000) == []


def test_network_gradient_viterbi_and_windows():
    rng = np.random.default_rng(0)
    p, x, y = lstm_crf.init(6, 5), rng.integers(0, 6, (3, 7)), rng.integers(0, 5, (3, 7))
    _, g = lstm_crf.loss(p, x, y)
    for k, value in p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            sides = []
            for step in (1e-5, -1e-5):
                q = {a: b.copy() for a, b in p.items()}
                q[k][at] += step
                sides.append(lstm_crf.loss(q, x, y)[0])
            assert abs((sides[0] - sides[1]) / 2e-5 - g[k][at]) < 1e-7
    import itertools
    scores = rng.normal(size=(4, 5))
    def total(tags):
        return sum(scores[i, t] for i, t in enumerate(tags)) + sum(p["A"][a, b] for a, b in zip(tags, tags[1:], strict=False)) + p["s"][tags[0]] + p["e"][tags[-1]]
    assert tuple(lstm_crf.viterbi(p, scores)) == max(itertools.product(range(5), repeat=4), key=total)
    many = [rng.normal(size=(n, 5)) for n in (3, 1, 40, 7, 7, 90, 2, 200)]
    assert all((x == lstm_crf.viterbi(p, s)).all() for x, s in zip(lstm_crf.paths(p, many, batch=3), many, strict=True))
    for n in (1, 96, 97, 500):
        covered = {i for at in pii.windows(0, n) for i in range(at, at + pii.WINDOW)}
        assert covered >= set(range(n))


def test_pii_learns_and_adds(spark):
    rng = random.Random(2)
    def phone():
        return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    rows = [(i, " ".join(rng.choices(["word", "Text", "more."], k=20)) + rng.choice([f" {phone()} and", f" x{i}@mail.example.com .", f" 10.{i % 200}.3.4 is", " no 12 here"])
             + " the end") for i in range(400)]
    rows += [(1000, f"call {phone()} 190.137.223.66 now"), (1001, None), (1002, ""), (None, "7" * 5000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int").repartition(3)
    model = pii.learn(df, sample=300, steps=60)
    got = {r.doc_id: r.spans for r in pii.find(df, model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert [(pii.KINDS.index(s.kind), s.start, s.end) for s in got[i] if s.kind in pii.KINDS] == plain_pii(t or "")
        for s in got[i]:
            if s.kind not in pii.KINDS:
                assert pii.possible(pii.KINDS.index(s.kind.removeprefix("lstm_")), t[s.start:s.end])
    redacted = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert redacted[1001] is None and redacted[1002] == "" and "555-" not in "".join(redacted[i] for i in range(400))
    assert pii.learn(df.limit(0)) is None and pii.find(df.limit(0), None).count() == 0


def test_pii_finds_what_the_patterns_do_not(spark):
    """Rewritten data that the network has not seen, in other surroundings, is found; plain texts are left alone."""
    rng = random.Random(8)
    word = lambda: rng.choice(["Some", "plain", "words", "stand", "here", "look", "at", "the", "total", "of", "12", "items."])
    name = lambda: "".join(rng.choices("abcdefghijklmnoprstu", k=rng.randrange(3, 9)))
    def datum(kind):
        if kind == 0:
            return f"{name()}.{rng.randrange(99)}@{name()}.{name()}.{rng.choice(['com', 'org', 'net'])}"
        if kind == 1:
            return ".".join(str(rng.randrange(256)) for _ in range(4))
        if kind == 2:
            d = "4" + "".join(rng.choices("0123456789", k=14))
            return next(d + c for c in "0123456789" if pii.luhn(d + c))
        return f"+{rng.randrange(1, 99)} ({rng.randrange(200, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
    around = lambda x: " ".join([word() for _ in range(rng.randrange(3, 15))] + [x] + [word() for _ in range(rng.randrange(3, 15))])
    train = spark.createDataFrame([(around(datum(i // 2 % 4)) if i % 2 else around(""),) for i in range(1600)], "text string")
    model = pii.learn(train, sample=600)
    hidden, clean = [], [around(word()) for _ in range(300)]
    for i in range(400):
        new = pii.rewrite(i % 4, datum(i % 4), rng.randrange(1000))
        text = around(new)
        if not any(a < text.index(new) + len(new) and text.index(new) < b for _, a, b in pii.pattern_spans(text)):
            hidden.append((i % 4, text, new))
    got = pii.model_spans(model, [t for _, t, _ in hidden] + clean, [pii.pattern_spans(t) for t in [t for _, t, _ in hidden] + clean])
    caught = collections.Counter(k for (k, t, new), g in zip(hidden, got, strict=False) if (len(pii.KINDS) + k, t.index(new), t.index(new) + len(new)) in g)
    asked = collections.Counter(k for k, _, _ in hidden)
    assert set(asked) == set(range(4)) and all(caught[k] >= 0.8 * n for k, n in asked.items()), (caught, asked)
    assert sum(map(len, got[len(hidden):])) == 0


def test_pii_rewritten_forms_are_possible():
    assert pii.possible(0, "jane.doe (at) mail [dot] example dot org") and pii.possible(0, "x@ mail . com") and pii.possible(1, "10[.]0 . 3(dot)4")
    assert not pii.possible(0, "look at the sea") and not pii.possible(0, "arrive at 5 dot 30") and not pii.possible(1, "1, 2, 3, 4")
    assert not pii.possible(1, "10[.]0[.]3[.]400") and pii.possible(3, "0049 30 1234567") and not pii.possible(3, "473696257")


# --- 10 secrets --------------------------------------------------------------

def plain_secrets(t):
    out = []
    for i, (k, p, g, n) in enumerate([
            ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
            ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]):
        out += [(m.start(), i, m.end()) for m in re.finditer(p, t) if len(m[g]) >= n]
    return sorted(out)


def test_secret_patterns_and_battery(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices(['token', '="', "=", " ", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "Api_Key:", "x", "é😀", "secret : ", "-"], k=rng.randrange(0, 14))))
            for i in range(300)]
    words = ["information", "international", "Organisation", "documentation", "responsibilities", "incomprehensibilities"]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    planted = {}
    for i in range(300, 700):
        t = " ".join("".join(rng.choices(words, k=2)).lower() for _ in range(12))
        if i % 4 == 0:
            planted[i] = "".join(rng.choices(letters, k=40))
            t += " " + planted[i] + " end"
        rows.append((i, t))
    rows += [(900, None), (901, ""), (None, "x" * 100_000)]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, spans int, token string").repartition(4)
    got = {r.doc_id: r.spans for r in secret_scan.scan(df).collect()}
    names = list(secret_scan.PATTERNS)
    found = collections.Counter()
    for i, t in rows:
        assert [(s.start, names.index(s.kind), s.end) for s in got[i] if s.kind != "random"] == plain_secrets(t or ""), t
        for s in got[i]:
            if s.kind == "random" and i is not None and i >= 300:
                found["planted" if t[s.start:s.end] == planted.get(i) else "false"] += 1
    assert found["planted"] > 0.8 * len(planted) and found["false"] <= 0.1 * found["planted"]
    assert secret_scan.scan(df.limit(0)).count() == 0


def test_secret_positions_in_one_long_text(spark):
    rng = random.Random(3)
    parts = [rng.choice(["é😀 ", "token= ", "x"]) + "".join(rng.choices("0123456789abcdef", k=rng.choice((31, 32, 40)))) for _ in range(20000)]
    text = " ".join(parts)
    begun = time.monotonic()
    got = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert time.monotonic() - begun < 90  # a running list that is copied for each match needs many minutes
    names = list(secret_scan.PATTERNS)
    assert [(s.start, names.index(s.kind), s.end) for s in got if s.kind != "random"] == plain_secrets(text)
    assert len(got) > 10000


def test_secrets_with_padding_and_names(spark):
    rng = random.Random(9)
    words = ["information", "international", "documentation", "responsibilities", "incomprehensibilities"]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, planted = [], {}
    for i in range(300):
        t = " ".join("".join(rng.choices(words, k=2)) for _ in range(12))
        if i % 3 == 0:  # padded base64 (two and one '='), and a value joined to its name
            secret = base64.b64encode(rng.randbytes(rng.choice((31, 32)))).decode() if i % 2 else "".join(rng.choices(letters, k=40))
            t += (" " if i % 2 else " export AWS_KEY=")
            planted[i] = (len(t), len(t) + len(secret))
            t += secret + " end"
        rows.append((i, t))
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for odd_ in (0, 1):
        mine = [i for i in planted if i % 2 == odd_]
        assert sum(planted[i] in got[i] for i in mine) > 0.8 * len(mine), odd_
    assert sum(s != planted.get(i) for i in got for s in got[i]) <= 0.1 * len(planted)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries_run(spark, name):
    if name in ("op5_passages", "op7_jaccard_join"):
        pytest.skip("compared with brute force in their own modules")
    assert queries.QUERIES[name](spark, SF).count() > 0


# --- memory and time on one long text ------------------------------------------

def test_long_runs_of_backslashes_are_read_once(spark):
    import time
    text = "\\" * 100_000
    df = spark.createDataFrame([(text,), (text + "</s>",), ("a" + text + "[INST] \\\\</s>",)], "t string")
    began = time.time()
    got = df.select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u")).collect()
    assert time.time() - began < 20 and all(r.t == r.u for r in got)
    assert [len(r.e) - len(r.t) for r in got] == [0, 1, 2]


def test_gram_vectors_are_made_in_slices(spark, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(3000)), "the cat sat on the mat " * 20, "le chat est sur la table " * 20]
    df = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(texts, ["zh", "en", "fr"]))], "doc_id long, text string, lang string").coalesce(1)
    whole = langid.predict(df, langid.train(df)).orderBy("doc_id").collect()
    grams = np.concatenate([g for _, g, _ in langid.gram_counts(texts)])
    counts = np.concatenate([c for _, _, c in langid.gram_counts(texts)])
    one = langid.bundles(counts, grams, np.float64)
    monkeypatch.setattr(langid, "SLICE", 100)
    assert len(grams) > 3000 and (langid.bundles(counts, grams, np.float64) == one).all()
    assert [r.lang_pred for r in whole] == ["zh", "en", "fr"]


def test_round_trip_equals_encode_then_decode(spark):
    df, path = odd(spark), queries.tokenizer_path()
    two = bpe.decode(bpe.encode(df, path), path)
    one = bpe.round_trip(df, path)
    assert one.schema == two.schema and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert bpe.round_trip(df.limit(0), path).collect() == []
