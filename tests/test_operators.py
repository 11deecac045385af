import datetime
import random

from pyspark.sql import functions as F

from chatlake.models import embedder as E
from chatlake.models.summarizer import FirstLine, summarize
from chatlake.operators import canonical, reuse, segment, stats, tree, union, upsert


def test_canonical_runs(spark):
    def flags(senders):
        df = spark.createDataFrame([("c", s, i, f"u{i:03}") for i, s in enumerate(senders)], "c string, s string, t int, u string")
        rows = canonical.mark_canonical(df, "c", "s", "t", "u").orderBy("t").collect()
        return [r["t"] + 1 for r in rows if r["is_canonical"]]

    assert flags(list("hahhha")) == [1, 2, 5, 6]
    assert flags(["h"]) == [1]
    assert flags(["h", "h"]) == [2]
    assert flags(list("haah")) == [1, 3, 4]
    assert flags([None, None, "h"]) == [2, 3]


def test_canonical_against_loop(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice(["h", "x", None]), r.choice([1, 2, 3, None]), f"u{i:04}") for i in range(300)]
    got = {x["u"]: x["is_canonical"] for x in canonical.mark_canonical(spark.createDataFrame(rows, "c string, s string, t int, u string"), "c", "s", "t", "u").collect()}
    want = {x[3]: False for x in rows}
    for c in ("a", "b"):
        seq = sorted((x for x in rows if x[0] == c), key=lambda x: (x[2] is None, x[2] or 0, x[3]))
        for i, x in enumerate(seq):
            want[x[3]] = i + 1 == len(seq) or seq[i + 1][1] != x[1]
    assert got == want


def test_upsert_actions(spark):
    t = spark.createDataFrame([("a", 1, "x", 5), ("b", 1, "x", 5), ("c", 1, "x", 5)], "k string, v int, kept string, g int")
    s = spark.createDataFrame([("b", 2, "y", 3), ("c", 1, "y", 9), ("d", 7, "y", 1)], "k string, v int, kept string, g int")
    got = {r["k"]: (r["v"], r["kept"], r["g"], r["_action"]) for r in upsert.upsert(t, s, ["k"], {"v": upsert.TAKE, "g": upsert.GREATEST}).collect()}
    assert got == {"a": (1, "x", 5, "skip"), "b": (2, "x", 5, "update"), "c": (1, "x", 9, "update"), "d": (7, "y", 1, "insert")}
    guarded = {r["k"]: r["_action"] for r in upsert.upsert(t, s, ["k"], {"v": upsert.TAKE}, newer="v").collect()}
    assert guarded == {"a": "skip", "b": "update", "c": "skip", "d": "insert"}
    again = upsert.upsert(t, t, ["k"], {"v": upsert.TAKE}, insert_only=True)
    assert {r["_action"] for r in again.collect()} == {"skip"}
    assert {r["action"]: r["n"] for r in upsert.action_counts(again).collect()} == {"skip": 3}


def test_collapse_against_loop(spark):
    r = random.Random(3)
    rows = [(f"k{r.randrange(20)}", r.randrange(4), f"d{i}", f"x{i}", i) for i in range(120)]
    want = {}
    for k, m, d, x, _ in rows:
        if k not in want:
            want[k] = [m, d, x]
        elif m > want[k][0]:
            want[k][0], want[k][2] = m, x
    df = spark.createDataFrame(rows, "k string, m int, d string, x string, i int")
    got = upsert.collapse(df, ["k"], {"m": upsert.TAKE, "d": upsert.KEEP, "x": upsert.TAKE}, "i", newer="m")
    assert {g["k"]: [g["m"], g["d"], g["x"]] for g in got.collect()} == want


def test_versions_against_fold(spark):
    r = random.Random(5)
    rows = [(f"k{r.randrange(15)}", r.choice([None, 1, 2, 3, 4]), i) for i in range(200)]
    stored, want = {}, {}
    for k, v, i in rows:
        old = stored.get(k, "none")
        ok = old == "none" or old is None or v is None or v > old
        want[i] = ok
        if ok:
            stored[k] = v
    got = upsert.accepted_versions(spark.createDataFrame(rows, "k string, v int, i int"), "k", "v", "i")
    assert {g["i"]: g["accepted"] for g in got.collect()} == want


def test_first_wins(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("y", 3, "n"), ("z", 4, "n")], "k string, v int, w string")
    assert sorted(map(tuple, union.first_wins([a, b], ["k"]).select("k", "v", "w").collect())) == [("x", 1, None), ("y", 2, None), ("z", 4, "n")]


def walk(m):
    root = next((i for i, n in m.items() if i != tree.CLIENT_ROOT and n["parent"] in (None, tree.CLIENT_ROOT)), None)
    if root is None and m.get(tree.CLIENT_ROOT, {}).get("children"):
        root = m[tree.CLIENT_ROOT]["children"][0]
    out, seen = [], set()
    while root in m and root not in seen:
        seen.add(root)
        if m[root]["message"] not in (None, {}):
            out.append(root)
        root = m[root]["children"][-1] if m[root]["children"] else None
    return out


def test_tree_path(spark):
    import json

    r = random.Random(8)
    trees = []
    for _ in range(60):
        n = r.randrange(1, 12)
        m = {f"n{i}": {"parent": None if i == 0 else f"n{r.randrange(i)}", "children": [], "message": r.choice([None, {}, {"a": 1}, {"a": 1}])} for i in range(n)}
        for i, v in m.items():
            if v["parent"]:
                m[v["parent"]]["children"].append(i)
        if r.random() < 0.3:
            m[f"n{n - 1}"]["children"] = [f"n{r.randrange(n)}"]  # a cycle
        if r.random() < 0.2:
            m[f"n{n - 1}"]["children"] = ["gone"]
        if r.random() < 0.3:
            m = {tree.CLIENT_ROOT: {"parent": None, "children": ["n0"], "message": None}, **m}
            m["n0"]["parent"] = r.choice([tree.CLIENT_ROOT, "other"])
        trees.append(m)
    trees.append({})
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)], "i int, j string")
    got = {x["i"]: x["p"] for x in df.select("i", tree.canonical_path(F.from_json("j", tree.MAPPING)).alias("p")).collect()}
    assert got == {i: walk(t) for i, t in enumerate(trees)}


def test_assets(spark):
    p = spark.createDataFrame([("z", "sediment://file_A"), ("z", "file-service://file-B"), ("z", "C"), ("z", ""), ("z", "file-service://none"), ("y", "C")], "archive string, asset_pointer string")
    m = spark.createDataFrame([("z", 0, "x/file_A.png"), ("z", 1, "file_A-1.png"), ("z", 2, "file_A-2.png"), ("z", 3, "file-Q_data/file-B-0.jpg"), ("z", 4, "aC.png"), ("z", 5, "d/C.png")], "archive string, ordinal int, member string")
    got = {(r["archive"], r["asset_pointer"]): r["member"] for r in tree.match_assets(p, m).collect()}
    assert got == {("z", "sediment://file_A"): "file_A-1.png", ("z", "file-service://file-B"): "file-Q_data/file-B-0.jpg", ("z", "C"): "d/C.png"}


def reference_chunks(raw, shown, bounds):
    n = len(raw)
    edges = [-1, *sorted({i for i, b in enumerate(bounds) if b} | {n - 1})]
    spans = [[a + 1, b] for a, b in zip(edges, edges[1:], strict=False)]
    i, out = 0, []
    while i < len(spans):
        a, b = spans[i]
        size = b - a + 1
        if size < 3 and i + 1 < len(spans):
            c = spans[i + 1][1]
            if sum(raw[a : c + 1]) <= 20000 or c - a + 1 >= 6:
                spans[i : i + 2] = [[a, c]]
                continue
        text = sum(shown[a : b + 1]) + 2 * (size - 1)
        if (size > 50 or text > 20000) and size >= 6:
            mid = a + size // 2
            spans[i : i + 1] = [[a, mid - 1], [mid, b]]
            continue
        out.append((a, b))
        i += 1
    return out


def test_cut_points():
    r = random.Random(1)
    for _ in range(3000):
        n = r.randrange(1, 130)
        raw = [r.choice([10, 500, 3000, 9000, 25000]) for _ in range(n)]
        shown = [max(5, x - r.choice([0, 0, x // 2])) + 10 for x in raw]
        bounds = [r.random() < 0.2 for _ in range(n)]
        got = segment.cut_points(raw, shown, bounds)
        assert got == reference_chunks(raw, shown, bounds)
        assert [i for a, b in got for i in range(a, b + 1)] == list(range(n))
    assert segment.cut_points([], [], []) == []
    assert segment.cut_points([1] * 4, [5] * 4, [False, False, True, False]) == [(0, 2), (3, 3)]
    assert segment.cut_points([1] * 60, [5] * 60, [False] * 60) == [(0, 29), (30, 59)]


def test_boundaries_and_gate(spark):
    v = {0: [1.0, 0.0], 1: [0.3, 0.9539392014169456], 2: None, 3: [1.0, 0.0], 4: [0.0, 1.0]}
    df = spark.createDataFrame([("c", i, f"u{i}", "human", "x", e) for i, e in v.items()], "conversation_id string, pos int, uuid string, role string, content string, embedding array<double>")
    b = segment.boundaries(segment.adjacent_similarity(df)).filter("is_boundary").collect()
    assert [r["pos"] for r in b] == [3]  # 0.3 itself is none, and a missing vector parts nothing
    assert segment.ready_conversations(df).count() == 1
    few = df.withColumn("embedding", F.when(F.col("pos") == 0, F.col("embedding")))
    assert segment.ready_conversations(few).count() == 0
    got = segment.segment(df).collect()
    assert [(r["start_msg_idx"], r["end_msg_idx"], r["message_count"]) for r in sorted(got, key=lambda r: r["start_msg_idx"])] == [(0, 3, 4), (4, 4, 1)]
    assert got[0]["chunk_text"].startswith("[HUMAN]: x")


def test_reuse_and_embedding(spark):
    pend = spark.createDataFrame([("1", "web", "same"), ("2", "web", "same"), ("3", "web", "new"), ("4", "web", "long " * 3000)], "source_uuid string, source_type string, content string")
    model = E.HashingEmbedder(8)
    h = pend.select(F.substring(F.sha2(F.lit("same"), 256), 1, 32)).first()[0]
    stored = spark.createDataFrame([("b", h, [2.0], "m"), ("a", h, [1.0], "m"), ("c", None, [3.0], "m")], "source_uuid string, content_hash string, embedding array<float>, model string")
    hit, rest = reuse.reuse_by_hash(pend, stored)
    assert {(r["source_uuid"], r["embedding"][0]) for r in hit.collect()} == {("1", 1.0), ("2", 1.0)}
    assert {r["source_uuid"] for r in rest.collect()} == {"3", "4"}
    made = {r["source_uuid"]: r["embedding"] for r in E.embed_pending(pend, model).collect()}
    assert made["1"] == made["2"] and len(made) == 4 and len(made["4"]) == 8
    small = E.HashingEmbedder(8, max_batch_chars=10)
    assert E.embed_halving(small, ["aa", "b" * 11, "cc"]) == [*small.embed(["aa"]), None, *small.embed(["cc"])]


def test_reembed_and_summaries(spark):
    t = spark.createDataFrame([("1", "h", [0.0], "old"), ("2", "h", [0.0], "old")], "source_uuid string, content_hash string, embedding array<float>, model string")
    got = {r["source_uuid"]: r["model"] for r in E.reembed(t, spark.createDataFrame([("1", "text"), ("2", "  ")], "source_uuid string, content string"), E.HashingEmbedder(4), "source_uuid", "content").collect()}
    assert got == {"1": "hashing-4", "2": "old"}

    class Broken:
        def summarize(self, text):
            raise ValueError

    df = spark.createDataFrame([("a", "[HUMAN]: \n[ASSISTANT]: hello"), ("b", None)], "k string, t string")
    assert {r["k"]: r["topic_summary"] for r in summarize(df, FirstLine(), ["k"], "t").collect()} == {"a": "hello", "b": ""}
    assert {r["topic_summary"] for r in summarize(df, Broken(), ["k"], "t").collect()} == {""}


def test_slices(spark):
    df = spark.createDataFrame([(f"k{i:03}",) for i in range(101)], "k string")
    got = sorted((r["k"], r["rn"], r["worker"]) for r in stats.worker_slice(df, "k", 7).collect())
    assert got == [(f"k{i:03}", i + 1, i % 7) for i in range(101)]


def test_pending_guards(spark):
    raw = spark.createDataFrame([("a", "user", '{"message":"m"}'), ("b", "user", '{"message":"' + "x" * 100000 + '"}'), ("c", "user", '{"c":{"type": "image"}}'), ("d", "system", "{}"), (None, "user", "{}"), ("e", "assistant", '{"q":1}')], "record_uuid string, record_type string, data string")
    stored = spark.createDataFrame([("z",)], "source_uuid string")
    assert {(r["source_uuid"], r["content"]) for r in reuse.pending_records(raw, stored).collect()} == {("a", "m"), ("e", '{"q":1}')}
    assert [r["source_uuid"] for r in reuse.pending_records(raw, stored, limit=1).collect()] == ["a"]


def test_spans(spark):
    from chatlake.plans import normalize

    t = lambda d: datetime.datetime(2024, 1, d)
    raw = spark.createDataFrame([("c", "d2", "p", t(3)), ("c", "d1", "p", t(2)), ("c", "d1", "p", t(5))], "conversation_id string, device string, project_path string, record_ts timestamp")
    r = normalize.agent_conversations(raw).first()
    assert (r["device"], r["created_at"].day, r["updated_at"].day) == ("d1", 2, 5)
