import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from concordat.llm import licences, mixing, pieces, queries, sql

from ..comparing import oracle, rows
from . import odd
from .test_dedup import left_lines, linked, words

MODEL = queries.TOKENIZERS + "/piece_bpe_32k.model"
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_matches_sql(spark, name):
    assert rows(queries.QUERIES[name](spark, SMALL).toArrow()) == rows(oracle(sql.SQL[name], SMALL))


def water(sizes, weights, cap):
    target, open_ = {}, set(sizes)
    rest = sum(sizes.values())
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if rest * weights[s] / w > cap * sizes[s]}
        if not over:
            return target | {s: rest * weights[s] / w for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        rest -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixing_targets(spark):
    rng = random.Random(1)
    data = [(i, " ".join(["w"] * rng.randrange(1, 40)), rng.choice("aaaaaaaabcd")) for i in range(300)] + [(900, "x y", None), (901, None, "a"), (902, "", "e"), (903, "p q", "d")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.mix(df).select("doc_id", "source", "mix.*").collect()
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    for s in order:
        mine = [r for r in out if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(want[s]) and mine[0]["source_size"] == sizes[s]
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 0.5
    assert all(r["taken"] <= 3 * r["size"] for r in out)
    assert all((r["position"] is None) == (r["taken"] == 0) and (r["position"] is None or 0 <= r["position"] <= 1) for r in out)
    again = mixing.mix(df.repartition(7)).select("doc_id", "source", "mix.*").collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_schedule_is_inverted(spark):
    for knots in mixing.SCHEDULES:
        t = np.linspace(0, 1, 20001)
        w = np.interp(t, *zip(*knots))
        share = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        share /= share[-1]
        us = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
        df = spark.createDataFrame([(u,) for u in us], "u double").select(mixing.invert(F.col("u"), knots).alias("t"))
        assert [r["t"] for r in df.collect()] == pytest.approx(np.interp(us, share, t).tolist(), abs=1e-3)


def test_mixed_documents(spark):
    data = [(i, f"a{i} b\tc{i}\n d e", "s" if i < 6 else "t") for i in range(9)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["mix"]["taken"] for r in mixing.mix(df).collect()}
    got = mixing.mixed_documents(df).collect()
    total = {}
    for r in got:
        whole = dict((i, t) for i, t, _ in data)[r["doc_id"]]
        assert whole.startswith(r["text"])
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + len(words(r["text"]))
    assert total == {k: v for k, v in taken.items() if v}


def test_mixing_odd_rows(spark):
    docs = odd.documents(spark, odd.odd_rows())
    out = mixing.mix(docs)
    assert out.count() == 9 and odd.kept(out) and out.columns == [*docs.columns, "mix"]
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mix(odd.documents(spark, [])).count() == 0 and mixing.mixed_documents(odd.documents(spark, [])).count() == 0
    only_empty = odd.documents(spark, [(1, None, "a"), (2, "", "b")])
    assert [r["mix"]["taken"] for r in mixing.mix(only_empty).collect()] == [0, 0] and mixing.mixed_documents(only_empty).count() == 0


def test_licences_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for name, t in licences.TEMPLATES.items():
        w = t.split()
        for drop in (0, 1, 2, len(w) // 3):
            x = [v for i, v in enumerate(w) if i not in set(rng.sample(range(len(w)), drop))]
            texts += [" ".join(x).upper(), "first line here\n" + " ".join(x) + "\nlast", "\n".join(x)]
    texts += ["", None, "one", "\n\n", "of of of of of of of", "no licence at all in this text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licences.license_scan(df).collect():
        want = []
        if r["text"] is not None:
            ls = r["text"].split("\n")
            for unit, t in [(-1, r["text"])] + ([*enumerate(ls)] if len(ls) > 1 else []):
                a = set(licences.bigrams_of(t))
                for name, tt in sorted(licences.TEMPLATES.items()):
                    b = set(licences.bigrams_of(tt))
                    if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.8:
                        want.append((unit, name, round(2 * len(a & b) / (len(a) + len(b)), 9)))
        assert [(m["unit"], m["template"], round(m["dice"], 9)) for m in r["licences"]] == want


def test_licences_of_the_documents_table(spark):
    """Every line of the table that names a licence is found, each under its own name."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '(?i)licen[cs]|creative commons|CC BY'")
    names = {"Released under the MIT License.": "MIT-notice", "Licensed under the Apache License, Version 2.0.": "Apache-2.0-notice", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-notice", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0-short"}
    seen = set()
    for r in licences.license_scan(docs.select("doc_id", "text")).collect():
        for i, line in enumerate(r["text"].split("\n")):
            if re.search("(?i)licen[cs]|creative commons|CC BY", line):
                seen.add(line)
                assert [m["template"] for m in r["licences"] if m["unit"] == i] == [names[line]]
    assert seen == set(names)


def test_licences_complete_files(spark):
    """Unchanged licence files, with their titles and copyright lines, match as whole texts."""
    here = Path(__file__).parent / "texts"
    want = {"mit": "MIT-full", "isc": "ISC-full", "bsd2": "BSD-2-Clause", "bsd3": "BSD-3-Clause"}
    data = [(k, v, (here / f"{k}.txt").read_text()) for k, v in want.items()]
    data += [(k, k, licences.TEMPLATES[k]) for k in ("Apache-2.0", "GPL-3.0", "MPL-2.0")]
    df = spark.createDataFrame(data, "name string, template string, text string")
    for r in licences.license_scan(df).collect():
        assert r["template"] in [m["template"] for m in r["licences"] if m["unit"] == -1], r["name"]


def test_licences_short_notices_are_told_apart(spark):
    short = {k: v for k, v in licences.TEMPLATES.items() if k.endswith("-short")}
    df = spark.createDataFrame(list(short.items()), "name string, text string")
    assert len(short) == 6 and all([m["template"] for m in r["licences"]] == [r["name"]] for r in licences.license_scan(df).collect())


def test_licences_passages(spark):
    """Wrapped notices inside a long text, and notices with other words beside them, are found once each."""
    rng = random.Random(4)
    filler = lambda n: " ".join(rng.choice(("alpha", "beta", "of", "the", "software", "gamma", "license")) + str(rng.randrange(50)) for _ in range(n))
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    data, want = [], []
    for name, t in licences.TEMPLATES.items():
        if len(t.split()) < 2000:
            data.append(filler(40) + "\n" + filler(9) + " " + wrap(t, 5 if len(t) < 300 else 12) + " " + filler(9) + "\n" + filler(30 + 2 * len(t.split())))
            want.append((name, 49, len(re.sub("[^a-z0-9]+", " ", t.lower()).split()), 1.0))
    data += ["Please note: " + licences.TEMPLATES["MIT-notice"] + " Thank you for reading this.", wrap(licences.TEMPLATES["MIT-notice"], 3) + "\n" + filler(30) + "\n" + wrap(licences.TEMPLATES["MIT-notice"], 2), filler(50)]
    want += [("MIT-notice", 2, 5, 1.0), None, None]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    for r in licences.license_scan(df).collect():
        got, w = [tuple(p) for p in r["licence_passages"]], want[r["doc_id"]]
        assert r["licences"] == []
        if w:
            assert w in got and sum(p[0] == w[0] for p in got) == 1
        else:
            assert got == ([] if r["doc_id"] == len(data) - 1 else [("MIT-notice", 0, 5, 1.0), ("MIT-notice", 35, 5, 1.0)])


def test_licences_edited_passages(spark):
    """The best window of every template, of all windows there are, is among the passages."""
    rng = random.Random(5)
    short = {k: t for k, t in licences.TEMPLATES.items() if len(t.split()) < 45}
    texts = []
    for t in short.values():
        for _ in range(6):
            w = t.split()
            for _ in range(1 + len(w) // 12):
                w[rng.randrange(len(w))] += rng.choice(("", " the", " extra words"))
            texts.append("zero one of the " + " ".join(w).replace(" ", "\n", 3) + " the license under two three " + "four five six " * 12)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licences.license_scan(df, templates=short).collect():
        w = re.sub("[^a-z0-9]+", " ", r["text"].lower()).split()
        whole = {m["template"] for m in r["licences"]}
        for name, t in short.items():
            b = set(licences.bigrams_of(t))
            best = 0
            for i in range(len(w)):
                for j in range(i + 2, min(len(w), i + 1 + int(1.5 * (len(re.sub("[^a-z0-9]+", " ", t.lower()).split()) - 1))) + 1):
                    a = set(f"{x} {y}" for x, y in zip(w[i:j], w[i + 1 : j]))
                    best = max(best, 2 * len(a & b) / (len(a) + len(b)))
            if name not in whole:
                assert max([p["dice"] for p in r["licence_passages"] if p["template"] == name], default=0) == pytest.approx(best if best >= 0.8 else 0)


def test_licences_odd_rows(spark):
    out = licences.license_scan(odd.documents(spark, odd.odd_rows()))
    assert out.count() == 9 and odd.kept(out) and all(r["licences"] == [] for r in out.collect())
    assert licences.license_scan(odd.documents(spark, [])).count() == 0


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return pieces.PieceCodec(f.read())


def viterbi(codec, text):
    """The whole lattice, kept in memory."""
    best = [(0.0, ())] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - codec.window), end):
            arc = codec.table.get(text[start:end])
            cost, ids = arc[0] if arc else codec.lowest, (arc[1],) if arc else tuple(codec.byte_ids[b] for b in text[start:end].encode())
            if (arc or start == end - 1) and (best[end] is None or best[start][0] + cost > best[end][0]):
                best[end] = (best[start][0] + cost, best[start][1] + ids)
    return list(best[-1][1])


TEXTS = ["Hello  world", " a", "  ", "\n\t x", "你好 😀 déjà", "a▁b", "ab" * 400, "x" * 1000, "".join(chr(33 + i * 7 % 90) for i in range(900)), "\0 nul"]


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_against_whole_lattice(codec, text):
    ids = np.frombuffer(codec.encode(text), np.int32).tolist()
    assert codec.decode(ids) == text
    if pieces.SPACE not in text:
        whole = (" " + text).replace(" ", pieces.SPACE)
        assert ids == viterbi(codec, whole) == [i for p in codec.stream(whole) for i in p]


def test_stream_commits_early(codec):
    seen = 0

    def characters():
        nonlocal seen
        for c in "the quick brown fox " * 50:
            seen += 1
            yield pieces.SPACE if c == " " else c

    next(codec.stream(characters()))
    assert seen <= 4 * codec.window


def test_pieces_round_trip(spark):
    docs = odd.documents(spark, odd.odd_rows())
    out = pieces.encode(docs, MODEL)
    assert odd.kept(out) and out.where("not pieces.exact").count() == 0 and out.count() == 9
    back = pieces.decode(out.select("doc_id", "text", "pieces.ids"), MODEL, to="again")
    assert back.where("not (text <=> again)").count() == 0
    assert pieces.encode(odd.documents(spark, []), MODEL).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toPandas(), stage(spark, docs, SMALL).schema)
        out[name] = before, docs.toPandas()
    return out


def test_pipeline_columns(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(b.columns) == columns for b, _ in stages.values())


def test_stage_toxicity_keeps_clean(stages, spark):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().set_index("doc_id")["toxic"]
    gone = set(before.doc_id) - set(after.doc_id)
    assert all(labels.get(i, 1) == 1 for i in gone)
    assert len(after) + len(gone) == len(before)


def test_stage_lines(stages):
    before, after = stages["line_dedup"]
    want = {(i, t) for i, t, _, n in left_lines(list(zip(before.doc_id.tolist(), before.text))) if n == 0 or t.strip(" ")}
    assert set(zip(after.doc_id.tolist(), after.text)) == want
    assert (after.n_chars == after.text.str.len()).all()


def test_stage_minhash(stages):
    before, after = stages["minhash"]
    b = before.sort_values("doc_id")
    _, roots = linked(b.text.tolist(), 5, 80)
    assert sorted(after.doc_id) == sorted({b.doc_id.iloc[r] for r in roots})


def test_stage_mixing(stages):
    before, after = stages["mixing"]
    size = before.assign(n=[len(words(t)) for t in before.text]).groupby("source").n.sum().to_dict()
    want = water(size, {s: i % 3 + 1 for i, s in enumerate(sorted(size))}, 3)
    got = after.assign(n=[len(words(t)) for t in after.text]).groupby("source").n.sum().to_dict()
    assert all(abs(got.get(s, 0) - want[s]) <= 0.5 for s in size)


def test_stage_pieces(stages, codec):
    before, after = stages["sentencepiece"]
    assert len(before) == len(after) and after.exact.all()
    assert sorted(codec.decode(i) for i in after.ids) == sorted(before.text)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stage_odd_rows(spark, tmp_path, k):
    name, stage = corpus_pipeline.STAGES[k]
    spark.createDataFrame([(1, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    full = [(i, t, "en", s, len(t or "")) for i, t, s in odd.odd_rows()]
    for data in (full, []):
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        out = stage(spark, docs, str(tmp_path))
        got = out.collect()
        assert bool(got) == bool(data)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        if name != "mixing":
            assert data == [] or None in {r["doc_id"] for r in got}


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).where("not exact").count() == 0


def test_one_of_each_keeps_different_texts(spark):
    words_ = lambda a: " ".join(f"{a}{i}" for i in range(40))
    rows = [(1, words_("a")), (1, words_("b")), (1, words_("a")), (2, words_("a") + " end"), (-3, words_("c")), (4, words_("c")), (None, words_("a")), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    runs = [sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, docs, "").collect()), key=str) for _ in range(2)]
    assert runs[0] == runs[1] == sorted([(1, words_("a")), (1, words_("b")), (-3, words_("c")), (None, words_("a")), (5, "")], key=str)


def test_lines_leave_no_blank_documents(spark):
    block = "one line\ntwo lines\nthree lines"
    rows = [(1, block), (2, "\n" + block + "\n"), (3, " \n \n "), (4, None), (5, block + "\nmore")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.remove_repeated_lines(spark, docs, "").collect()}
    assert got == {1: block, 3: " \n \n ", 4: None, 5: "more"}


def test_workers_need_no_package(tmp_path):
    """All queries and the pipeline from another folder, where only the driver has the package on its path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(__file__).resolve().parents[2])
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
def where(_):
    try:
        import concordat
        yield 1
    except ImportError:
        yield 0
assert s.sparkContext.parallelize([0], 1).mapPartitions(where).sum() == 0, "workers see the package"
import __spark_entry__ as e
for name, f in e.queries().items():
    if name == "pipeline" or name.startswith("op") and name[2].isdigit():
        print("RAN", name, f(s, {SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and done.stdout.count("RAN") == 11, done.stdout[-500:] + done.stderr[-2000:]
