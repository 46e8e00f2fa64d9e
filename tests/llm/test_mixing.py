import random
import re
from collections import Counter, defaultdict

from tests.llm.helpers import empty, frame, odd_documents, words
from tillroll.llm import mixing as M


def fill(sizes):
    """Water-filling by hand: sources in order, weights 3, 1, 2."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] < weight[s] * level}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets_and_takings(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randrange(80)), "en", rng.choice(["a"] * 6 + ["b", "c", "é", "Z", None]), 0)
            for i in range(400)]
    docs = frame(spark, rows)
    served = M.serve(docs).withColumn("words", M.taken_words(0) + M.taken_words(1)).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in served:
        source = r["_row"]["source"]
        sizes[source] += r["size"]
        taken[source] += r["words"]
        target[source] = r["target"]
        assert 0 <= r["words"] <= 2 * r["size"]
    want = fill(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 and taken[s] == int(want[s] + 1e-9)


def test_mixture_order_and_shares(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randrange(1, 60)), "en", rng.choice("aaab"), 0) for i in range(300)]
    out = M.mix(frame(spark, rows)).collect()
    finish = [r["mix_finish"] for r in out]
    assert finish == sorted(finish) and finish[-1] <= 1
    cut = [r for r in out if r["mix_taken"] < len(rows[r["doc_id"]][1].split())]
    assert len(cut) <= 2 and all(len(r["text"].split()) == r["mix_taken"] for r in out)
    assert Counter(map(tuple, out)) == Counter(map(tuple, M.mix(frame(spark, rows)).collect()))  # reruns agree
    # At any time sources have been served in proportion to their targets.
    served = defaultdict(int)
    for r in out[:len(out) // 2]:
        served[r["source"]] += r["mix_taken"]
    total = Counter()
    for r in out:
        total[r["source"]] += r["mix_taken"]
    assert max(abs(served[s] / total[s] - finish[len(out) // 2]) for s in total) < 0.05


def test_odd_rows(spark):
    rows = odd_documents()
    docs = frame(spark, rows)
    served = M.serve(docs).collect()
    assert Counter(r["_row"]["doc_id"] for r in served) == Counter(r[0] for r in rows)
    out = M.mix(docs)
    assert set(docs.columns) < set(out.columns) and out.where("mix_taken = 0").count() == 0
    assert M.mix(empty(spark)).count() == 0
    blank = frame(spark, [(1, "", "en", "a", 0), (2, None, "en", "b", 0)])
    assert M.mix(blank).count() == 0


def test_words_taken_are_those_of_the_stream(spark):
    """Sums over the sorted copies equal the closed form of the cut, also for rows without id, words or source."""
    rng = random.Random(3)
    rows = [(rng.choice([None, i, 7]), words(rng, rng.randrange(40)), "en", rng.choice(["a", "a", "b", None]), 0) for i in range(300)]
    docs = frame(spark, rows)
    closed = M.serve(docs, carry=["doc_id"]).select("_row.doc_id", "size", "source_size", "target",
                                                    (M.taken_words(0) + M.taken_words(1)).alias("taken"))
    assert Counter(map(tuple, M.mixed_words(docs, ["doc_id"]).collect())) == Counter(map(tuple, closed.collect()))
    assert M.mixed_words(empty(spark), ["doc_id"]).count() == 0


def test_rows_without_id_spread_and_reruns_agree(spark):
    rng = random.Random(4)
    rows = [(None, words(rng, 20), "en", "a", i) for i in range(400)] + [(i, words(rng, 20), "en", "b", i) for i in range(50)]
    docs = frame(spark, rows)
    keys = docs.where("doc_id IS NULL").select(M.shuffle_key(docs["doc_id"], docs["text"], 17).substr(1, M.SLICE_DIGITS).alias("s"))
    assert keys.distinct().count() > 300  # slices, each a task's share
    first, again = (list(map(tuple, M.mix(d).collect())) for d in (docs, docs.repartition(13)))
    assert first == again


def test_texts_are_shuffled_once_before_the_sort(spark, capsys):
    """Running totals and offsets share one shuffle of the rows; the sorted copies take another."""
    rng = random.Random(5)
    docs = frame(spark, [(i, words(rng, 20), "en", rng.choice(["a", "b", "", None]), 0) for i in range(200)], clashing=False)
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    for k, v in plain.items():
        spark.conf.set(k, v)
    try:
        M.mix(docs.repartition(3)).explain("formatted")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (\w+)", capsys.readouterr().out)
    with_text = [how for columns, how in moved if "_row#" in columns]
    assert sorted(with_text) == ["hashpartitioning", "rangepartitioning"]


def test_sources_without_name_keep_apart_from_empty_names(spark):
    rows = [(i, f"w{i} x y", "en", s, 0) for i in range(60) for s in ("", None, "=", "a", "aa")]
    served = M.serve(frame(spark, rows)).collect()
    for s in ("", None, "=", "a", "aa"):
        own = sorted((r["start"], r["size"]) for r in served if r["source"] == s)
        assert own == [(3 * k, 3) for k in range(60)] and {r["source_size"] for r in served if r["source"] == s} == {180}
