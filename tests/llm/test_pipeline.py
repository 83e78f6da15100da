"""The stages of the pipeline against brute force, each on what the one before it kept."""

import re
from collections import Counter

import corpus_pipeline
from mizzen.llm.op6_mixing import mixture
from tests.llm.test_operators import brute_lines, brute_near, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows():
    text = lambda i: "\n".join(prose(f"{i}-{j}", 40) + "." for j in range(3))
    out = [(i, text(i), "en", f"s{i % 4}") for i in range(40)]
    out += [(100 + i, text(1), "en", "s0") for i in range(3)]
    out += [(110 + i, text(2).replace(".", f" tail{i}.", 1), "en", "s1") for i in range(3)]
    out += [(120, None, "en", None), (121, "", None, "s1"), (None, text(77), "en", "s2"), (122, "short text", "en", "s1"), (123, "BUY NOW!! " * 80, "en", "s3")]
    out += [(130, text(3) + "\n" + prose("item", 30) + ".", "en", "s1"), (5, text(5), "en", "s1"), (140, f"{text(90)}\nHome | About | Contact | Help", "en", "s2")]
    return out


def test_stages(spark, tmp_path):
    d = str(tmp_path)
    table(spark, rows()).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, prose("item", 30) + ".")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        out.write.parquet(f"{d}/{k}")
        before, docs = docs, spark.read.parquet(f"{d}/{k}")
        seen[name] = (before, docs)
        assert name == "mixing" or docs.columns == columns
    pairs = lambda df: [(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()]

    before, after = seen["quality_rules"]
    assert Counter(i for i, _ in pairs(after)) == Counter(i for i, *_ in rows() if i not in (120, 121, 122, 123))
    nav = "\nHome | About | Contact | Help"
    assert Counter(pairs(after)) == Counter((i, t.removesuffix(nav)) for i, t, *_ in rows() if i not in (120, 121, 122, 123))
    assert all(x.n_chars == len(x.text) for x in after.collect())
    before, after = seen["line_dedup"]
    want = [(i, t) for i, t in brute_lines(pairs(before), 5) if WORD.search(t)]
    assert sorted(pairs(after), key=str) == sorted(want, key=str)
    before, after = seen["near_dedup"]
    kept = {i for i, _, _, k in brute_near(pairs(before), 5, 80) if k}
    assert Counter(i for i, _ in pairs(after)) == Counter(kept)
    before, after = seen["decontamination"]
    assert {i for i, _ in pairs(before)} - {i for i, _ in pairs(after)} == {130}
    before, after = seen["mixing"]
    takes = {x.doc_id: len(x.takes) for x in mixture(before).collect()}
    texts = dict(pairs(before))
    made = after.collect()
    assert Counter(x.doc_id for x in made) == Counter({i: n for i, n in takes.items() if n})
    assert all(x.text == texts[x.doc_id] and x.taken == len(WORD.findall(x.text)) for x in made)
    assert after.columns == [*columns, "shard", "order", "pass", "taken"]
    again = [tuple(x) for x in corpus_pipeline.run(spark, d).collect()]
    assert sorted(again, key=str) == sorted((tuple(x) for x in made), key=str)
    place = after.columns.index("shard")
    assert all(a[place + 1] <= b[place + 1] for a, b in zip(again, again[1:]) if a[place] == b[place])


def test_empty(spark, tmp_path):
    d = str(tmp_path)
    table(spark, rows()).limit(0).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
