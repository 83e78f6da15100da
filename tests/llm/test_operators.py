"""Each operator against a brute-force version, and on nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mizzen.llm import op1_chat, op2_decontaminate, op3_perplexity, op4_tokens, op5_lines, op6_mixing, op7_quality, op8_license, op9_substring, op10_near

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that documents may also have, named like what operators use inside.
CLASH = "key string, node long, pos int, rank long, place int, version int, n long, size long, block int, words string, kept boolean, m string, first_id long"
DOC = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def table(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *("en", "src0")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
    filler = ("x", 1, 1, 1, 1, 1, 1, 1, 1, "x", True, "x", 1)
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *filler) for i, t, g, s in full], DOC)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Prose with exact copies, near copies, shared passages and odd rows."""
    r = random.Random(5)
    passage = prose("passage", 70)
    rows = [(i, prose(i, 120)) for i in range(20)]
    rows += [(20 + i, rows[0][1]) for i in range(3)]
    for i in range(12):  # near copies
        w = rows[1][1].split()
        w[r.randrange(len(w))] = f"changed{i}"
        rows.append((30 + i, " ".join(w)))
    rows += [(50 + i, f"{prose(500 + i, 60)}\n{passage}\t{prose(600 + i, 30)}") for i in range(4)]
    rows += [(60, None), (61, ""), (62, " \t\n"), (None, rows[2][1]), (None, None), (63, "one two"), (64, "One  TWO"), (65, "same " * 150), (66, "same " * 130)]
    rows += [(2, rows[2][1]), (67, prose(3, 4000) + " " + passage)]
    return rows


def results(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus()).cache()


def test_chat_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    nasty = ["\\", "\\\\[INST]", "<<s>", "<|x|>\n", "</s>\n", "<", "a\\", "[\\INST]", "<<SYS>>\\n", "", "é😀</s>"]
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (2, 0, "assistant", "a"), (3, 0, "user", None), (3, 1, None, "x"), (4, 1, "user", "t"), (4, 1, "user", "t"), (None, 0, "user", "n")]
    rows += [(5, i, ["user", "assistant", "od|d"][i % 3], x) for i, x in enumerate(nasty)] + [(6, 0, "system", "s"), (6, 1, "user", "u"), (6, 2, "assistant", "x" * 200_000)]
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, turns int, segments string")
    made = op1_chat.format_conversations(given).withColumn("back", op1_chat.read_turns(F.col("formatted"))).collect()
    want = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.back] for r in made} == want
    assert {r.conv_id: (r.valid, r.bad_turn) for r in made} == {1: (True, -1), 2: (False, 0), 3: (False, 1), 4: (False, 1), None: (True, -1), 5: (False, 2), 6: (True, -1)}
    for r in made:
        assert "".join(s.text for s in r.segments) == r.formatted
        marks = [s.loss for s in r.segments[1:]]
        assert marks == [x for role, _ in want[r.conv_id] for x in (False, role == "assistant", False)]
    assert op1_chat.format_conversations(given.limit(0)).count() == 0


def test_decontamination(spark, docs):
    base = prose(7, 120).split()
    items = [(1, " ".join(base[10:50])), (2, "too short"), (3, None), (4, prose("absent", 30)), (5, prose(3, 4000).upper()[-400:]), (6, " ".join([*base[60:75], "new", *base[76:100]]))]
    items += [(7, "one  two"), (None, " ".join(base[80:110])), (8, "ONE two three four"), (1, " ".join(base[10:50])), (9, ""), (10, "same")]
    items = [(i, t, "x", 1) for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string, shingles string, need int")
    split = lambda t, n: [tuple(w[i : i + n]) for w in [WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))] for i in range(len(w) - n + 1)]
    want = []
    for d, t in corpus():
        for i, b, *_ in items:
            width = min(5, len(WORD.findall(b or "")))
            need, own = (set(split(b, width)), set(split(t, width))) if width else (set(), set())
            if need and 100 * len(own & need) >= 80 * len(need):
                want.append((d, i, len(own & need), len(need)))
    found = op2_decontaminate.contained_items(docs, bench).drop("version")
    assert results(found) == sorted(want, key=str) and len(want) >= 2
    kept = op2_decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in corpus()) - Counter(d for d, *_ in want)
    assert op2_decontaminate.contained_items(docs, bench.limit(0)).count() == 0
    assert op2_decontaminate.contained_items(docs.limit(0), bench).count() == 0


def test_decontamination_without_broadcast(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, prose(7, 120))], "item_id long, text string")
    want = results(op2_decontaminate.contained_items(docs, bench))
    monkeypatch.setattr(op2_decontaminate, "BROADCAST_ROWS", 0)
    assert results(op2_decontaminate.contained_items(docs, bench)) == want and want


def kneser_ney(texts):
    """Probability function of the model, by dictionaries."""
    counts = Counter(int(k) for t in texts for k in op3_perplexity.runs(t))
    levels = {4: counts}
    for n in (3, 2, 1):
        levels[n] = Counter(k & ((1 << 16 * n) - 1) for k in levels[n + 1])
    discounts, contexts = {}, {}
    for n, c in levels.items():
        m = Counter(c.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0
        d = [k - (k + 1) * y * m[k + 1] / m[k] if m[k] else 0 for k in (1, 2, 3)]
        discounts[n] = d if all(0 < x < k for k, x in zip((1, 2, 3), d)) else [0.5, 1.0, 1.5]
        contexts[n] = defaultdict(lambda: [0, 0.0])
        for k, v in c.items():
            contexts[n][k >> 16][0] += v
            contexts[n][k >> 16][1] += discounts[n][min(v, 3) - 1]

    def p(key, n):
        if n == 0:
            return 1 / (len(levels[1]) + 1)
        key &= (1 << 16 * n) - 1
        total, lost = contexts[n].get(key >> 16, (0, 0.0))
        if not total:
            return p(key, n - 1)
        c = levels[n].get(key, 0)
        return (c - discounts[n][min(c, 3) - 1] if c else 0) / total + lost / total * p(key, n - 1)

    return lambda key: p(int(key), 4)


def test_perplexity(spark):
    r = random.Random(1)
    say = lambda n: " ".join(r.choice(["the", "cat", "sat", "on", "a", "mat", "and", "ran"]) for _ in range(n)) + "."
    rows = [(i, say(30), "en", "s") for i in range(30)] + [(i, say(20).upper(), "fr", "s") for i in range(30, 40)]
    rows += [(40, "%%$$ ##@@ zq" * 20, "en", "s"), (41, None, "en", "s"), (42, "", "fr", "s"), (43, "x", "de", "s"), (44, "y", None, "s"), (None, say(9), "en", "s"), (0, say(30), "en", "s"), (45, "the cat " * 5000, "en", "s"), (46, "😀 cat", "en", "s")]
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(0, 40)] + [(0, 1, 0, "x"), (40, 0, 0, "x"), (None, 1, 0, "x"), (41, 1, 1, "x"), (45, None, None, "x")], "doc_id long, quality int, toxic int, lang string")
    given = table(spark, rows)
    out = op3_perplexity.classify(given, labels)
    got = results(out)
    model = {g: kneser_ney([t for i, t, lang, _ in rows if i is not None and i < 40 and lang == g]) for g in ("en", "fr")}
    for i, t, lang, _ in rows:
        mine = [x for x in got if x[0] == i]
        if lang not in model:
            assert mine[0][2:] == (None, None, True)
            continue
        keys = op3_perplexity.runs(t)
        want = math.exp(-sum(math.log(model[lang](k)) for k in keys) / keys.size)
        assert any(abs(x[2] - want) < 1e-6 * want for x in mine), (i, want, mine)
    verdict = {x[0]: x[4] for x in got}
    assert not verdict[40] and all(verdict[i] for i in range(40))
    known = {int(k) & 0xFFFF for i, t, lang, _ in rows if i is not None and i < 40 and lang == "en" for k in op3_perplexity.runs(t)}
    context = ((ord("c") << 16 | ord("a")) << 16 | ord("t")) << 16
    assert sum(model["en"](context | u) for u in [*known, 0x2603]) == pytest.approx(1)
    sharded = results(op3_perplexity.classify(given, labels, broadcast_runs=0))
    assert [(*x[:2], x[4]) for x in sharded] == [(*x[:2], x[4]) for x in got]
    assert all(a[2] == b[2] or abs(a[2] - b[2]) < 1e-9 * b[2] for a, b in zip(sharded, got))
    none = op3_perplexity.classify(given, labels.limit(0))
    assert all(x.kept and x.perplexity is None for x in none.collect())
    assert op3_perplexity.classify(given.limit(0), labels).count() == 0


def test_threshold_is_that_of_unseen_texts(spark):
    r = random.Random(2)
    say = lambda n: " ".join("".join(r.choice("aeiourstln") for _ in range(r.randrange(2, 7))) for _ in range(n))
    texts = [say(r.randrange(5, 30)) for _ in range(80)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(80, texts[0], "en", "s"), (81, "only one", "fr", "s"), (82, "zzzz", "fr", "s")]
    given = table(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(82)], "doc_id long, quality int, toxic int")
    fold = {x.doc_id: x.f for x in given.select("doc_id", op3_perplexity._folded(F.col("text")).alias("f")).collect()}
    value = []
    for half in (0, 1):
        p = kneser_ney([t for i, t, g, _ in rows if g == "en" and fold[i] != half])
        for i, t, g, _ in rows:
            if g == "en" and fold[i] == half:
                keys = op3_perplexity.runs(t)
                value.append(math.exp(-sum(math.log(p(k)) for k in keys) / keys.size))
    for most in (op3_perplexity.BROADCAST_RUNS, 0):
        for quantile in (0.99, 0.5):
            got = op3_perplexity.classify(given, labels, quantile, broadcast_runs=most).collect()
            want = sorted(value)[math.ceil(quantile * len(value)) - 1]
            assert len(got) == len(rows)
            for x in got:
                if x.lang == "fr":
                    assert x.threshold is None and x.kept and x.perplexity > 0
                else:
                    assert x.threshold == pytest.approx(want) and x.kept == (x.perplexity <= x.threshold)


@pytest.mark.parametrize("rule", op4_tokens.RULES)
def test_tokens(spark, docs, rule):
    texts = ["a\n\n\nb", "", "\n", "é\né", "line one\nline two\n", "  \n  x", "日本\n語😀\n", "x" * 30_000 + "\n" + "yz " * 2000, None]
    given = table(spark, list(enumerate(texts)) + [(None, "q\nr"), (3, texts[3])])
    encoding, lengths = op4_tokens.encoder(op4_tokens.VOCABULARY)
    for row in op4_tokens.count_tokens(given, rule=rule).collect():
        text = "q\nr" if row.doc_id is None else texts[row.doc_id]
        if text is None:
            assert row[1:] == (0, 0, 0, [])
            continue
        ids = encoding.encode_ordinary(text)
        assert encoding.decode(ids) == text and sum(lengths[i] for i in ids) == len(text.encode())
        owner = [0] * len(text)
        for i in range(1, len(text)):
            owner[i] = owner[i - 1] + (text[i - 1] == "\n")
        at = [i for i, c in enumerate(text) for _ in c.encode()]
        want, place, crossing = [0] * (text.count("\n") + 1), 0, 0
        for i in ids:
            chars = sorted(set(at[place : place + lengths[i]]))
            sections = [owner[c] for c in chars]
            crossing += sections[0] != sections[-1]
            pick = {"first": sections[0], "last": sections[-1], "largest": min(sections, key=lambda s: (-sections.count(s), s))}[rule]
            want[pick] += 1
            place += lengths[i]
        assert (row.n_tokens, row.n_sections, row.n_crossing, row.section_tokens) == (len(ids), len(want), crossing, want)
    assert op4_tokens.count_tokens(docs.limit(0)).count() == 0


def brute_lines(rows, least):
    """Texts without later copies of runs of lines, of any length, that have ``least`` words."""
    solid = {k: [x for x in (t or "").split("\n") if WORD.search(x)] for k, (i, t) in enumerate(rows)}
    first, gone = {}, defaultdict(set)
    spans = [(rows[k][0], p, k, d) for k, ls in solid.items() if rows[k][0] is not None for d in range(1, len(ls) + 1) for p in range(len(ls) - d + 1)]
    for i, p, k, d in spans:
        run = tuple(solid[k][p : p + d])
        first[run] = min(first.get(run, (i, p)), (i, p))
    for i, p, k, d in spans:
        run = tuple(solid[k][p : p + d])
        if sum(len(WORD.findall(x)) for x in run) >= least and first[run] < (i, p):
            gone[k].update(range(p, p + d))
    out = []
    for k, (i, t) in enumerate(rows):
        if t is None:
            out.append((i, None))
            continue
        at, rest = 0, []
        for x in t.split("\n"):
            if WORD.search(x):
                if at not in gone[k]:
                    rest.append(x)
                at += 1
            else:
                rest.append(x)
        out.append((i, "\n".join(rest)))
    return sorted(out, key=str)


def test_lines(spark):
    r = random.Random(3)
    pool = [prose(f"l{i}", n) for i, n in enumerate([1, 2, 2, 3, 6, 6, 9, 1, 1, 2])] + ["", "  "]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(1, 14)))) for i in range(40)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (90, None), (91, ""), (92, "\n\n"), (93, "\n".join(["a b c d e"] * 300))]
    given = table(spark, rows)
    out = op5_lines.dedup_lines(given)
    assert out.columns == given.columns
    assert results(out.select("doc_id", "text")) == brute_lines(rows, 5)
    assert op5_lines.dedup_lines(given.limit(0)).count() == 0


def test_lines_of_every_length(spark):
    r = random.Random(6)
    pool = [prose(f"l{i}", n) for i, n in enumerate([1, 1, 1, 2, 2, 3, 6])] + [""]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(1, 16)))) for i in range(40)]
    rows += [(100 + i, f"Home\nAbout us\nContact us\n{prose(i, 9)}") for i in range(3)]
    rows += [(110 + i, "\n".join([prose(20 + i, 9), "a b c d e", "f", "g", prose(30 + i, 9)])) for i in range(2)]
    rows += [(120 + n, f"{prose(40 + n, 9)}\n" + "\n".join(f"m{k}" for k in range(n)) + f"\n{prose(50 + n, 9)}") for n in (4, 5, 6, 7, 9, 9)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (90, None), (91, "")]

    def brute(least):
        solid = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, t in rows]
        spans = [(tuple(ls[p : p + d]), rows[k][0], p, k) for k, ls in enumerate(solid) if rows[k][0] is not None for p in range(len(ls)) for d in range(1, len(ls) - p + 1)]
        first, gone = {}, defaultdict(set)
        for run, i, p, _ in spans:
            first[run] = min(first.get(run, (i, p)), (i, p))
        for run, i, p, k in spans:
            if first[run] < (i, p) and sum(len(WORD.findall(x)) for x in run) >= least:
                gone[k].update(range(p, p + len(run)))
        return sorted(((i, [x for p, x in enumerate(solid[k]) if p not in gone[k]]) for k, (i, _) in enumerate(rows)), key=str)

    for least in (1, 3, 5, 7, 8):
        out = op5_lines.dedup_lines(table(spark, rows), least)
        assert sorted(((x.doc_id, [y for y in (x.text or "").split("\n") if WORD.search(y)]) for x in out.collect()), key=str) == brute(least), least


def test_mixing(spark):
    r = random.Random(4)
    names = ["a", "b", "c", "d", "é", "", None]
    rows = [(i, prose(i, r.randrange(1, 60)), "en", "b" if i % 3 == 0 else r.choice(names)) for i in range(3000)]
    rows += [(5000, None, "en", "empty"), (5001, "", "en", "empty"), (None, prose(1, 20), None, None), (7, rows[7][1], "en", rows[7][3]), (5002, prose(2, 3), "en", "tiny")]
    given = table(spark, rows)
    out = op6_mixing.mixture(given).cache()
    got = out.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rate >= 3 * sizes[s]}
        if not over:
            target |= {s: weight[s] * rate for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
        left, open_ = left - sum(target[s] for s in over), open_ - over
    taken, shards = Counter(), Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(target[x.source])
        assert len(x.takes) <= 3 and len({t["pass"] for t in x.takes}) == len(x.takes)
        taken[x.source] += x.size * len(x.takes)
        shards.update(t.shard for t in x.takes)
    for s in order:
        assert 0 <= target[s] - taken[s] + 1e-6 < 60, s
    assert set(shards) == set(range(16))
    assert results(out) == results(op6_mixing.mixture(given.repartition(3)))
    made = op6_mixing.shuffled_shards(out, given).collect()
    assert len(made) == sum(shards.values()) and Counter(x.shard for x in made) == shards
    assert Counter((x.doc_id, x.text, x.source, x.shard) for x in made) == Counter((x.doc_id, t, x.source, y.shard) for x, t in ((x, {(r[0], r[3]): r[1] for r in rows}[x.doc_id, x.source]) for x in got) for y in x.takes)
    for k in shards:
        order = [x.order for x in made if x.shard == k]
        assert order == sorted(order) and [x.doc_id or -1 for x in made if x.shard == k] != sorted(x.doc_id or -1 for x in made if x.shard == k)
    assert op6_mixing.shuffled_shards(op6_mixing.mixture(given.limit(0)), given.limit(0)).count() == 0
    assert op6_mixing.mixture(given.limit(0)).count() == 0


def test_splitting_tree(spark):
    quotas = {1: 40, 2: 0, 3: 7, 4: 100}
    given = spark.createDataFrame(list(quotas.items()), "source_no long, n long")
    means = Counter()
    for seed in range(12):
        leaves = op6_mixing.split_quotas(given, 5, seed).collect()
        by_source, by_shard = Counter(), Counter()
        for x in leaves:
            assert x.n >= 0
            by_source[x.source_no] += x.n
            by_shard[x.shard] += x.n
            means[x.source_no] += x.n if x.shard == 0 else 0
        assert {k: by_source[k] for k in quotas} == quotas
        assert max(by_shard.values()) - min(by_shard.values()) <= 2
    assert abs(means[4] / 12 - 20) < 3 and abs(means[1] / 12 - 8) < 3


def test_quality(spark, docs):
    clean = "\n".join(prose(f"c{i}", 30) + "." for i in range(6))
    texts = {
        1: (clean, True), 2: (clean + "\nHome | About | Contact | Help", True), 3: ("\n".join(prose(i, 20).replace("w", "%$w") for i in range(6)), False),
        4: (" ".join(f"SHOUT{chr(65 + i % 26)}{chr(65 + i // 26)}NOW" for i in range(90)) + ".", False), 5: ("ab cd ef. " * 60, False), 6: (prose(1, 49), False), 7: (None, False), 8: ("", False),
        9: (prose(2, 90), False), 10: ("\n".join(["Home | News | About | Us | Login"] * 3 + [prose("z", 60) + "."]), True), 11: ("Éé. " + clean, True),
    }
    given = table(spark, [(i, t) for i, (t, _) in texts.items()] + [(None, clean), (1, clean)])
    got = op7_quality.assess(given).collect()
    for x in got:
        t, kept = texts[x.doc_id or 1]
        t = t or ""
        w = WORD.findall(t)
        lines = [y for y in t.split("\n") if WORD.search(y)]
        runs = Counter(zip(w, w[1:], w[2:]))
        twice = {j for i, y in enumerate(zip(w, w[1:], w[2:])) if runs[y] > 1 for j in (i, i + 1, i + 2)}
        failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(twice), failed, kept)
        assert tuple(x)[1:] == want, x.doc_id
    out = op7_quality.clean(given)
    assert out.columns == given.columns
    assert "About" not in out.where("doc_id = 2").first().text and out.where("doc_id = 1").count() == 2
    assert op7_quality.assess(docs.limit(0)).count() == 0
    assert op7_quality.assess(table(spark, [(1, "word " * 100_000)])).first().n_repeat_words == 100_000


def test_licenses(spark, docs):
    r = random.Random(2)
    fold = lambda t: WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}).translate({ord(c): None for c in op8_license.MARKS}))
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    rows = []
    for k, (name, text) in enumerate(op8_license.TEMPLATES):
        rows.append((k, f"{prose(k, r.randrange(60))} {text.upper()}\n{prose(k + 50, 40)}"))
        broken = text.split()
        broken[len(broken) // 2] = "broken"
        rows.append((100 + k, f"{prose(k, 9)} {' '.join(broken)} {prose(k, 9)}"))
    rows += [(200, None), (201, ""), (None, op8_license.TEMPLATES[0][1]), (0, rows[0][1]), (202, prose(1, 9000) + " " + op8_license.TEMPLATES[2][1])]
    want, sets = [], {name: set(shingles(fold(text))) for name, text in op8_license.TEMPLATES}
    for i, text in dict(rows).items():  # the repeated row is reported once
        own = set(shingles(fold(text)))
        want += [(i, name, len(x & own), len(x)) for name, x in sets.items() if 100 * len(x & own) >= 80 * len(x)]
    assert {(k, name) for k, (name, _) in enumerate(op8_license.TEMPLATES)} <= {x[:2] for x in want}
    assert results(op8_license.scan(table(spark, rows)).drop("place")) == sorted(want, key=str)
    assert op8_license.scan(docs.limit(0)).count() == 0
    assert op8_license.scan(docs, templates=(("x", "short"),)).count() == 0


def brute_repeats(rows, window):
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        for p in range(len(w) - window + 1 if i is not None else 0):
            run = tuple(w[p : p + window])
            first[run] = min(first.get(run, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_repeats(spark, docs):
    assert results(op9_substring.remove_repeats(docs).drop("rest")) == brute_repeats(corpus(), 50)
    assert op9_substring.remove_repeats(docs.limit(0)).count() == 0


def test_repeats_periodic(spark):
    """Long runs and periods, where few symbols are whole inside a window."""
    r = random.Random(9)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(4):
            period = [f"p{r.randrange(3)}" for _ in range(r.randrange(1, 7))]
            parts += period * r.randrange(1, 30) + [f"q{r.randrange(30)}"] * r.randrange(0, 2)
        rows.append((r.randrange(40), " ".join(parts)))
    assert results(op9_substring.remove_repeats(table(spark, rows)).drop("rest")) == brute_repeats(rows, 50)


def brute_near(rows, size, percent):
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate({k: k + 32 for k in range(65, 91)}))
        sets.append({tuple(w[p : p + size]) for p in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if None not in (rows[a][0], rows[b][0]) and both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), least[root(k)] if i is not None else None, i is None or i == least[root(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def test_near(spark, docs):
    for size, percent in ((3, 85), (5, 80)):
        assert results(op10_near.near_duplicates(docs, size, percent)) == brute_near(corpus(), size, percent)
    kept = op10_near.drop_near_duplicates(docs, 3, 85)
    assert kept.columns == docs.columns
    want = Counter({i: 1 for i, _, c, k in brute_near(corpus(), 3, 85) if k and i is not None})
    assert Counter(x.doc_id for x in kept.collect() if x.doc_id is not None) == want
    assert op10_near.near_duplicates(docs.limit(0)).count() == 0


def test_near_borderline(spark):
    """Many texts about one base, with links on both sides of the threshold and hubs that link few."""
    r = random.Random(11)
    base = prose("b", 60, 10_000).split()
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(len(w))] = f"x{r.randrange(40)}"
        rows.append((r.randrange(10_000), " ".join(w)))
    rows = list({i: (i, t) for i, t in rows}.values())
    assert results(op10_near.near_duplicates(table(spark, rows), 3, 85)) == brute_near(rows, 3, 85)


def test_components(spark):
    from mizzen.llm.components import connected_components

    r = random.Random(8)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(70)] + [(5, 5), (7, None)]
    got = {x.vertex: x.component for x in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in pairs:
        if b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for v in sorted(near):
        if v not in want:
            todo = [v]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = v
                    todo += near[x]
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_recompression_is_local():
    """Away from its ends, a passage gets the same symbols wherever it stands."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 6, 200).astype(np.uint64)
    seen = []
    for n in (0, 17, 90):
        words = np.concatenate([rng.integers(0, 6, n).astype(np.uint64), passage, rng.integers(0, 6, 40).astype(np.uint64)])
        (name,), start = op9_substring.recompress(words, np.zeros(words.size, dtype=np.int64))
        inside = (start >= n + op9_substring.REACH) & (np.append(start[1:], words.size) <= n + 200 - op9_substring.REACH)
        seen.append(list(zip(name[inside], start[inside] - n)))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 20


def test_one_id_with_several_texts(spark):
    """Rows of one id stand for their texts: none is lost to another's near copy."""
    a, b, c = (prose(f"many{i}", 80) for i in range(3))
    near = a.replace(a.split()[40], "other", 1)
    rows = [(3, a), (5, a), (5, b), (5, b), (7, c), (7, near), (9, c), (11, c.upper()), (11, c), (None, b), (5, None), (5, "")]
    given = table(spark, rows)
    assert results(op10_near.near_duplicates(given, 3, 80)) == brute_near(rows, 3, 80)
    kept = sorted((str(x.doc_id), x.text or "") for x in op10_near.drop_near_duplicates(given, 3, 80).collect())
    assert kept == sorted([("3", a), ("5", b), ("7", c), ("None", b), ("5", ""), ("5", "")])
    assert op10_near.drop_near_duplicates(given.limit(0)).count() == 0


def test_low_threshold(spark):
    """The bands follow the threshold, so pairs at half are met too."""
    r = random.Random(12)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: r.randrange(38, 61)], *[f"x{i}-{k}" for k in range(r.randrange(0, 12))]])) for i in range(40)]
    assert results(op10_near.near_duplicates(table(spark, rows), 3, 50, rows=2)) == brute_near(rows, 3, 50)
    assert op10_near.bands_for(85, 5) == 25 and op10_near.bands_for(80, 5) == 37 and op10_near.bands_for(100, 5) == 1


def test_hub(spark):
    """A vertex with 20,000 edges, and a chain beside it."""
    from mizzen.llm.components import connected_components

    far = spark.range(1, 20_001).selectExpr("0L AS a", "id AS b").unionByName(spark.range(30_000, 30_020).selectExpr("id AS a", "id + 1 AS b"))
    got = connected_components(far).groupBy("component").count().collect()
    assert {x.component: x["count"] for x in got} == {0: 20_001, 30_000: 21}


def test_spanning_links():
    rng = np.random.default_rng(3)
    for n, share in ((12, 0.1), (40, 0.04), (60, 0.02), (5, 0)):
        linked = np.triu(rng.random((n, n)) < share, 1)
        linked |= linked.T
        part = rng.integers(0, n // 2, n)
        part = np.unique(part, return_inverse=True)[1]
        a, b = op10_near._spanning(linked, part)
        assert linked[a, b].all() and a.size < part.max() + 1

        def groups(pairs):
            own = list(range(part.max() + 1))
            for x, y in pairs:
                one, two = own[part[x]], own[part[y]]
                own = [one if k == two else k for k in own]
            return [[k == m for k in own] for m in own]

        assert groups(zip(a, b)) == groups(zip(*np.nonzero(linked)))


def test_exact_quantile(spark):
    r = random.Random(4)
    rows = [(g, r.choice([r.random() * 50 + 1, 7.25, 7.2500001, 3.0])) for g in "abc" for _ in range({"a": 1, "b": 50, "c": 700}[g])]
    given = spark.createDataFrame(rows, "g string, v double")
    for q in (0.01, 0.5, 0.99, 1.0):
        want = {g: sorted(v for h, v in rows if h == g)[math.ceil(q * sum(h == g for h, _ in rows)) - 1] for g in "abc"}
        assert {x.g: x.v for x in op3_perplexity.exact_quantile(given, "g", "v", q).collect()} == want


def test_license_table(spark):
    """Templates may be a table of any size; equal texts and names, and short or null ones among them."""
    long = [(f"t{i}", prose(f"license{i}", 20 + i % 90)) for i in range(260)]
    given = spark.createDataFrame([*long, ("t3", long[3][1]), ("short", "too short"), ("none", None)], "template string, text string")
    rows = [(i, f"{prose(i, 30)} {long[i][1]} {prose(i + 900, 30)}") for i in (3, 77, 259)]
    got = op8_license.scan(table(spark, rows), given).select("doc_id", "template", "n_shared", "n_shingles")
    assert [(x.doc_id, x.template, x.n_shared == x.n_shingles) for x in got.orderBy("doc_id").collect()] == [(3, "t3", True), (77, "t77", True), (259, "t259", True)]
    assert op8_license.scan(table(spark, rows), given.limit(0)).count() == 0


def test_very_long_texts(spark):
    """A text of over 100,000 characters goes through every operator whole."""
    long = "\n".join(prose(f"long{i}", 40, 100_000) + "." for i in range(500))
    tail, item, license_ = prose("tail", 60, 100_000), prose("item", 30, 100_000), op8_license.TEMPLATES[2][1]
    text = f"{long}\n{tail}\n{item}\n{license_}"
    assert len(text) > 100_000
    given = table(spark, [(1, f"{prose('head', 60)}\n{tail}"), (2, text), (3, text + " more"), (4, None), (5, "")])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(x.doc_id for x in op2_decontaminate.contained_items(given, bench).collect()) == [2, 3]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert op3_perplexity.classify(given, labels).where("perplexity > 0").count() == 5
    assert sorted((x.doc_id, x.text.count("\n")) for x in op5_lines.dedup_lines(given).where("doc_id < 4").collect()) == [(1, 1), (2, text.count("\n") - 1), (3, 0)]
    assert {x.doc_id: x.size for x in op6_mixing.mixture(given).collect()} == {1: 120, 2: len(text.split()), 3: len(text.split()) + 1, 4: 0, 5: 0}
    assert sorted((x.doc_id, x.template) for x in op8_license.scan(given).collect()) == [(2, "GPL-3.0"), (3, "GPL-3.0")]
    rows = [(x.doc_id, x.text) for x in given.select("doc_id", "text").collect()]
    assert results(op9_substring.remove_repeats(given).drop("rest")) == brute_repeats(rows, 50)
    assert results(op10_near.near_duplicates(given, 3, 85)) == brute_near(rows, 3, 85)


def test_columns_stay(spark):
    """Without a column for the length of the text, none comes."""
    given = table(spark, [(1, "\n".join(prose(f"s{i}", 30) + "." for i in range(6)))]).drop("n_chars")
    assert op7_quality.clean(given).columns == given.columns and op5_lines.dedup_lines(given).columns == given.columns


def test_repeats_long(spark):
    """Repeats of hundreds of words, among them near copies, whose symbols Spark names; symbols verify windows."""
    r = random.Random(21)
    base = prose("repeat", 2000, 5000).split()
    rows = [(i, prose(f"own{i}", 200)) for i in range(3)]
    for i in range(12):
        low = r.randrange(0, 1200)
        w = base[low : low + r.randrange(60, 800)]
        for _ in range(r.randrange(0, 3)):
            w[r.randrange(len(w))] = f"other{i}"
        rows.append((r.randrange(3, 40), f"{prose(f'h{i}', 40)} {' '.join(w)} {prose(f't{i}', r.randrange(0, 70))}"))
    rows += [(50, " ".join(base)), (51, " ".join(["a", "b"] * 700)), (52, " ".join(["a", "b"] * 600)), (50, " ".join(base))]
    given = table(spark, rows)
    assert results(op9_substring.remove_repeats(given).drop("rest")) == brute_repeats(rows, 50)
    base_rows = op9_substring._scan(given.select("doc_id", "text"), 50)
    found = op9_substring.verified_spans(base_rows.where("n >= 50"), 50).collect()
    assert sum(h - low for x in found for low, h in zip(x.lows, x.highs)) > 500


def test_mixing_many_sources(spark):
    """A thousand sources, one of which holds a third of the rows."""
    r = random.Random(15)
    rows = [(i, "w " * r.randrange(0, 9), "en", "big" if i % 3 == 0 else f"s{r.randrange(1000):04}") for i in range(6000)]
    got = op6_mixing.mixture(table(spark, rows)).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for x in got:
        sizes[x.source] += x.size
        taken[x.source] += x.size * len(x.takes)
        targets[x.source] = x.target
    assert len(got) == len(rows) and sum(sizes.values()) == sum(len(t.split()) for _, t, *_ in rows)
    order = sorted(sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    free = {s for s in order if targets[s] < 3 * sizes[s] - 1e-6}
    assert len({round(targets[s] / weight[s], 6) for s in free}) == 1 and all(0 <= targets[s] - taken[s] + 1e-6 < 9 for s in order)


def test_hypergeometric_draws(spark):
    """Draws of a small urn occur as often as they should; those of a large one have its mean and spread."""
    draws = lambda n, places, blocks, k: [x.d for x in spark.range(k).select(op6_mixing._drawn(*[F.lit(v).cast("bigint") for v in (n, places, blocks)], op6_mixing._uniform(F.lit(9), "id")).alias("d")).collect()]
    for n, places, blocks in ((3, 4, 9), (5, 5, 6), (2, 7, 7), (6, 0, 9), (0, 3, 9), (1, 1, 2)):
        seen = Counter(draws(n, places, blocks, 4000))
        for k in range(max(0, places + n - blocks), min(n, places) + 1):
            p = math.comb(n, k) * math.comb(blocks - n, places - k) / math.comb(blocks, places)
            assert abs(seen.pop(k, 0) / 4000 - p) < 5 * math.sqrt(p * (1 - p) / 4000) + 1e-9, (n, places, blocks, k)
        assert not seen
    got = np.array(draws(65_536, 500_000, 1_000_003, 3000))
    spread = math.sqrt(500_000 * 0.065536 * 0.934464 * 500_003 / 1_000_002)
    assert abs(got.mean() - 500_000 * 65_536 / 1_000_003) < 5 * spread / math.sqrt(3000) and abs(got.std() / spread - 1) < 0.08
