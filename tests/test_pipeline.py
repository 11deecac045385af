import io
import json
import os
import zipfile

import pytest

from chatlake.plans import pipeline as P
from chatlake.sources import jsonl, zip_json


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(P.Warehouse, "BUCKETS", 4)


def put(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body if isinstance(body, bytes) else body.encode())


def archive(items, members=()):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("conversations.json", json.dumps(items))
        for n, c in members:
            z.writestr(n, c)
    return b.getvalue()


@pytest.fixture
def world(tmp_path):
    logs = tmp_path / "logs"
    good = [{"type": "user", "uuid": "r1", "timestamp": "2024-01-01T00:00:00Z", "sessionId": "s", "message": "hi\x00"}, {"type": "assistant", "uuid": "r2", "parentUuid": "r1", "timestamp": 1704067260000, "message": {"role": "assistant", "content": "yo"}}, {"type": "summary", "uuid": "r3", "content": [{"text": "sum"}]}]
    lines = "\n".join([json.dumps(good[0]), "", "{bad", json.dumps(good[1]), json.dumps(good[2])])
    put(str(logs / "dev1/.claude/projects/-home-u-x/agent-a04b965.jsonl"), lines)
    put(str(logs / "dev1/.claude/projects/plain/b.jsonl"), '[1,2]\n{"type":"user","uuid":"q1"}')
    msgs = [{"uuid": f"m{i}", "sender": s, "text": t, "content": [], "created_at": f"2024-02-01T00:0{i}:00Z", "updated_at": "2024-02-01T00:00:00Z"} for i, (s, t) in enumerate([("human", "a"), ("human", "b"), ("assistant", "c")])]
    conv = {"uuid": "w1", "name": "", "summary": "S", "created_at": "2024-02-01T00:00:00Z", "updated_at": "2024-02-02T00:00:00Z", "account": {"uuid": "acc", "email_address": "e@x.test"}, "chat_messages": msgs}
    web = tmp_path / "web"
    put(str(web / "1.zip"), archive([conv, {"uuid": "w2", "account": None, "chat_messages": []}]))
    put(str(web / "2.zip"), archive([{**conv, "updated_at": "2024-02-01T00:00:00Z", "name": "older"}]))
    put(str(web / "3.zip"), b"no zip")
    node = lambda p, c, role, parts: {"parent": p, "children": c, "message": role and {"author": {"role": role}, "create_time": 1.7e9, "content": {"content_type": "text", "parts": parts}}}
    mapping = {"root": node(None, ["x"], None, []), "x": node("root", ["y", "z"], "user", ["q", {"content_type": "image_asset_pointer", "asset_pointer": "file-service://file-A", "width": 3}]), "y": node("x", [], "assistant", ["old"]), "z": node("x", [], "assistant", ["new"])}
    tree = tmp_path / "tree"
    put(str(tree / "t.zip"), archive([{"id": "t1", "title": "T", "create_time": 1.7e9, "update_time": 1.7e9, "mapping": mapping}], [("file-A-pic.png", b"png!")]))
    return tmp_path


def test_jsonl(spark, world):
    lines = jsonl.read_session_logs(spark, str(world / "logs"))
    records, errors = jsonl.parse_records(lines)
    rows = {(r["project_path"], r["line_number"]): r for r in records.collect()}
    assert sorted(rows) == [("/home/u/x", 1), ("/home/u/x", 4), ("/home/u/x", 5)]
    first = rows["/home/u/x", 1]
    assert first["device"] == "dev1" and first["record_uuid"] == "r1" and "\\u0000" not in first["data"] and first["file_mtime"] is not None
    assert rows["/home/u/x", 4]["record_ts"].isoformat() == "2024-01-01T00:01:00"
    assert errors.count() == 1
    assert [tuple(r) for r in jsonl.count_files(spark, str(world / "logs")).collect()] == [("dev1", 2)]


def test_zip(spark, world):
    paths = zip_json.list_archives([str(world / "web"), str(world / "web")])
    assert [os.path.basename(p) for p in paths] == ["1.zip", "2.zip", "3.zip"]
    items, members, errors = zip_json.read_archives(spark, paths)
    assert items.count() == 3 and errors.count() == 1 and members.count() == 2
    convs, bad = zip_json.web_conversations(items)
    assert bad.count() == 1 and {r["name"] for r in convs.collect()} == {"S", "older"}
    dry = {r["archive"].rsplit("/", 1)[1]: (r["n_conversations"], r["n_messages"]) for r in zip_json.dry_run(items, members).collect()}
    assert dry == {"1.zip": (2, 3), "2.zip": (1, 3)}


def test_end_to_end(spark, world):
    w = P.Warehouse(spark, str(world / "wh"))
    assert P.ingest_logs(w, str(world / "logs")) == {"insert": 3, "error": 1}
    assert P.ingest_logs(w, str(world / "logs")) == {"skip": 3, "error": 1}
    paths = zip_json.list_archives([str(world / "web")])
    first = P.ingest_web(w, paths)
    assert {k: first[k] for k in ("insert", "error", "messages_insert")} == {"insert": 1, "error": 2, "messages_insert": 3}
    assert [f.rsplit("/", 1)[1] for f in first["failed"]] == ["1.zip", "3.zip"]
    again = P.ingest_web(w, paths[:1])  # nothing newer
    assert (again["skip"], again["error"], again.get("insert"), again.get("update")) == (1, 1, None, None)
    assert w.read("web_raw").first()["name"] == "S"
    got = P.ingest_tree(w, [str(world / "tree/t.zip")], str(world / "att"))
    assert (got["insert"], got["messages_insert"], got["attachments"]) == (1, 3, 1)
    a = w.read("attachments").first()
    assert a["filename"] == "file-A-pic.png" and a["content_type"] == "image/png" and open(a["file_path"], "rb").read() == b"png!"
    assert {r["message_id"]: r["is_canonical"] for r in w.read("tree_messages").collect()} == {"x": True, "y": False, "z": True}
    n = P.run_normalize(w)
    assert n == {"accounts": 1, "conversations": 3, "messages": 3 + 2 + 2}
    assert P.run_normalize(w, "append") == n
    assert {r["uuid"]: r["is_canonical"] for r in w.read("web_messages").collect()} == {"m0": False, "m1": True, "m2": True}
    made = P.run_embed(w)
    assert made["insert"] == 3 + 2 + 2
    assert P.run_embed(w).get("insert", 0) == 0
    topics = P.run_topics(w)
    assert topics["insert"] >= 1
    assert P.run_topics(w).get("insert", 0) == 0
    assert {r["source_type"]: r["percent"] for r in P.run_status(w).collect()}["web"] == 100
    P.archive_done(paths, lambda _: {"error": 1, "failed": ["file:/x/1.zip"]}, [str(world / "web")])
    assert os.path.exists(paths[0]) and sorted(os.listdir(world / "web/processed")) == ["2.zip", "3.zip"]
    P.archive_done(paths[:1], lambda _: {}, [str(world / "elsewhere")])
    assert os.path.exists(paths[0])
    P.archive_done(paths[:1], lambda _: {})
    assert os.path.exists(str(world / "web/processed/1.zip"))


def test_reembedding(spark, world):
    from chatlake.models.embedder import HashingEmbedder

    w = P.Warehouse(spark, str(world / "wh2"))
    P.ingest_web(w, [str(world / "web/1.zip")])
    P.run_normalize(w)
    P.run_embed(w)
    assert P.run_topics(w, limit=1)["insert"] >= 1
    n = w.read("message_embeddings").count()
    half = [P.run_reembed_messages(w, HashingEmbedder(64), k, 2) for k in (0, 1)]
    assert half == [n, n] and {(r["model"], len(r["embedding"])) for r in w.read("message_embeddings").collect()} == {("hashing-64", 64)}
    P.run_reembed_topics(w, HashingEmbedder(32))
    assert all((len(r["embedding"]) == 32 if r["topic_summary"] else r["embedding"] is None) for r in w.read("topics").collect())
    parts = [w.read("web_messages").select("uuid").transform(lambda d, k=k: P.segment.hash_slice(d, "uuid", k, 3)).count() for k in range(3)]
    assert sum(parts) == 3


def test_refused_text_is_cut():
    from chatlake.models import embedder as E

    m = E.HashingEmbedder(16, max_batch_chars=7000)
    long = "alpha beta gamma delta " * 600
    got = E.embed_halving(m, ["short", long, "other"])
    assert all(v is not None for v in got) and got[0] == m.embed(["short"])[0]
    assert E.embed_halving(E.HashingEmbedder(16, max_batch_chars=10), ["x" * 50]) == [None]


def node(p, c, role, parts):
    return {"parent": p, "children": c, "message": role and {"author": {"role": role} if role != "?" else {}, "create_time": 1.7e9, "content": {"content_type": "text", "parts": parts}}}


def test_older_export_after_newer(spark, tmp_path):
    """An older export changes nothing; messages of every version that counted stay."""
    v = lambda t, said, extra: {"id": "t1", "title": f"T{t}", "create_time": 1.7e9, "update_time": t, "mapping": {"x": node(None, ["y"], "user", ["q"]), "y": node("x", [], "?", [said]), **extra}}
    for name, items in (("1.zip", [v(10.0, "first", {"only1": node("x", [], "assistant", ["kept"])}), v(20.0, "second", {})]), ("2.zip", [v(15.0, "stale", {"late": node("x", [], "assistant", ["no"])})]), ("3.zip", [v(30.0, "third", {})])):
        put(str(tmp_path / name), archive(items, [("file-A.png", b"x")]))
    w = P.Warehouse(spark, str(tmp_path / "wh"))
    got = P.ingest_tree(w, [str(tmp_path / "1.zip")])
    assert (got["insert"], got["messages_insert"]) == (1, 3)
    state = lambda: ({r["message_id"]: (r["sender"], r["content"]) for r in w.read("tree_messages").collect()}, w.read("tree_raw").first()["title"])
    want = ({"x": ("user", "q"), "y": ("unknown", "second"), "only1": ("assistant", "kept")}, "T20.0")
    assert state() == want
    got = P.ingest_tree(w, [str(tmp_path / "2.zip")])
    assert (got.get("insert"), got.get("update"), got["skip"]) == (None, None, 1) and state() == want
    P.ingest_tree(w, [str(tmp_path / "2.zip"), str(tmp_path / "3.zip")])
    assert state() == ({**want[0], "y": ("unknown", "third")}, "T30.0")


def test_attachments_again(spark, world):
    w = P.Warehouse(spark, str(world / "wh3"))
    t = str(world / "tree/t.zip")
    assert "attachments" not in P.ingest_tree(w, [t])
    assert P.ingest_tree(w, [t], str(world / "att"))["attachments"] == 0
    got = P.ingest_tree(w, [t], str(world / "att"), reprocess_attachments=True)
    assert (got["attachments"], got.get("insert"), got.get("update")) == (1, None, None)
    assert P.dry_run(w, str(world / "logs"), [t])["logs"] == {"dev1": 2} and list(P.dry_run(w, None, [t])["archives"].values()) == [(1, 0, 1)]


def test_limit_of_changed_conversations(spark, world):
    w = P.Warehouse(spark, str(world / "wh4"))
    log = lambda n: put(str(world / f"logs2/d/.claude/projects/p/{n}.jsonl"), json.dumps({"type": "user", "uuid": n, "message": n}))
    for n in ("a", "b", "c"):
        log(n)
    sizes = []
    for _ in range(4):
        P.ingest_logs(w, str(world / "logs2"), limit=1)
        sizes.append(w.read("agent_raw").count())
    assert sizes == [1, 2, 3, 3]


def test_merges_touch_only_their_buckets(spark, tmp_path):
    from chatlake.operators import upsert

    w = P.Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.range(400).selectExpr("cast(id as string) k", "id v")
    assert w.merge("t", rows, ["k"], {"v": upsert.TAKE}) == {"insert": 400}
    before = dict(w._at()["t"]["paths"])
    first = w.read("t")
    assert len(before) == w.BUCKETS
    assert w.merge("t", spark.createDataFrame([("7", 70), ("7x", 1), ("8", 8)], "k string, v bigint"), ["k"], {"v": upsert.TAKE}, newer="v") == {"insert": 1, "update": 1, "skip": 1}
    after = w._at()["t"]["paths"]
    assert 1 <= sum(before[k] != after[k] for k in before) <= 3
    assert first.count() == 400  # the snapshot before can still be read
    assert w.read("t").count() == 401 and w.read("t").filter("k = '7'").first()["v"] == 70
    w.swap({"t": w.read("t").filter("v < 10")})
    assert w.merge("t", rows.limit(0), ["k"], {}) == {} and w.merge("t", rows.filter("v = 3"), ["k"], {"v": upsert.TAKE}) == {"update": 1}
    w.merge("t", rows.filter("v = 3"), ["k"], {"v": upsert.TAKE}, newer="v")
    on_disk = {p for p in os.listdir(tmp_path / "wh") if p.startswith("t-")}
    assert len(on_disk) <= 3


def test_normalising_again_keeps_and_takes(spark, tmp_path):
    """Names are overwritten, first dates and devices kept, last dates only grow."""
    from chatlake.plans import normalize as N

    t = lambda d: f"2024-01-0{d}"
    conv = lambda *r: spark.createDataFrame([r], "conversation_id string, account_id string, name string, summary string, created_at string, updated_at string")
    got = N.merge_web_conversations(conv("c", "a", "old", "s1", t(1), t(5)), conv("c", "b", "new", "s2", t(2), t(3))).first()
    assert (got["account_id"], got["name"], got["summary"], got["created_at"], got["updated_at"]) == ("a", "new", "s2", t(1), t(5))
    agent = lambda *r: spark.createDataFrame([r], "conversation_id string, device string, project_path string, created_at string, updated_at string")
    got = N.merge_agent_conversations(agent("c", "d1", "/p", t(2), t(3)), agent("c", "d2", "/q", t(1), t(4))).first()
    assert (got["device"], got["project_path"], got["created_at"], got["updated_at"]) == ("d1", "/p", t(2), t(4))
    acc = lambda *r: spark.createDataFrame([r], "account_id string, email string, first_seen string, last_seen string")
    got = N.merge_accounts(acc("a", "e1", t(1), t(2)), acc("a", "e2", t(3), t(4))).first()
    assert (got["email"], got["first_seen"], got["last_seen"]) == ("e1", t(1), t(4))
    w = P.Warehouse(spark, str(tmp_path / "wh"))
    raw = lambda name, day: spark.createDataFrame([("c", "a", "e", None, name, None, "{}", "f")], P.WEB_RAW).withColumn("updated_at", P.F.lit(t(day)).cast("timestamp"))
    for name, day, want in (("n1", 5, 5), ("n2", 3, 5), ("n3", 6, 6)):
        w.swap({"web_raw": raw(name, day)})
        P.run_normalize(w)
        r = w.read("web_conversations").first()
        assert (r["name"], r["updated_at"].day) == (name, want)


def test_stages():
    def bad():
        raise ValueError("x")

    p = P.Pipeline([("a", lambda: 1), ("b", bad), ("c", lambda: 3)])
    out = p.run(skip={"a"})
    assert isinstance(out["b"], ValueError) and out["c"] == 3 and "a" not in out
    with pytest.raises(ValueError, match="x"):
        P.Pipeline([("b", bad)], on_error="stop").run()
    assert P.Pipeline([("b", bad)]).run(dry=True) == {"b": "not run"}


def test_streams(spark, tmp_path):
    from chatlake.operators import upsert
    from chatlake.streaming import tables as S

    src, wh = str(tmp_path / "src"), P.Warehouse(spark, str(tmp_path / "wh"))
    schema = "k string, v int, x string"
    spark.createDataFrame([("a", 1, "one"), ("a", 3, "three"), ("b", 1, "b")], schema).coalesce(1).write.parquet(src)
    S.merge_stream(S.read_table_stream(spark, src, schema), wh, "t", ["k"], {"v": upsert.TAKE, "x": upsert.TAKE}, "v", str(tmp_path / "ck")).awaitTermination()
    spark.createDataFrame([("a", 2, "late"), ("b", 5, "new")], schema).coalesce(1).write.mode("append").parquet(src)
    S.merge_stream(S.read_table_stream(spark, src, schema), wh, "t", ["k"], {"v": upsert.TAKE, "x": upsert.TAKE}, "v", str(tmp_path / "ck")).awaitTermination()
    assert {r["k"]: (r["v"], r["x"]) for r in wh.read("t").collect()} == {"a": (3, "three"), "b": (5, "new")}
    msrc = str(tmp_path / "m")
    spark.createDataFrame([("u1", "t"), ("u2", "t"), ("u3", "")], "uuid string, content string").write.parquet(msrc)
    S.embed_stream(S.read_table_stream(spark, msrc, "uuid string, content string"), wh, "uuid", "content", "web", str(tmp_path / "ck2")).awaitTermination()
    assert {r["source_uuid"] for r in wh.read("message_embeddings").collect()} == {"u1", "u2"}
    left = [3, 0]
    assert S.until_done(lambda: left.pop(0)) == 1


def test_remote_model(tmp_path, monkeypatch):
    import http.server
    import threading

    from chatlake.models import embedder as E
    from chatlake.models import remote as R

    calls = []

    class Service(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            got = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            calls.append((self.headers["Authorization"], len(got["input"])))
            code, out = (400, {"error": "maximum context length"}) if sum(map(len, got["input"])) > 7000 else (503, {}) if len(calls) == 1 else (200, {"data": [{"index": i, "embedding": [float(len(t)), 1.0]} for i, t in reversed(list(enumerate(got["input"])))]})
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    put(str(tmp_path / "key"), "k1\n")
    m = R.HttpEmbedder(f"http://127.0.0.1:{server.server_port}/", "m", 2, (str(tmp_path / "none"), str(tmp_path / "key")))
    assert E.embed_halving(m, ["ab", "c" * 9000, "d"]) == [[2.0, 1.0], [(6000 + 3300) / 2, 1.0], [1.0, 1.0]]
    assert {a for a, _ in calls} == {"Bearer k1"}
    monkeypatch.setenv("SOME_KEY", "k2")
    assert R.find_key([], "SOME_KEY") == "k2"
    with pytest.raises(LookupError):
        R.find_key([str(tmp_path / "none")], "NO_SUCH_KEY")
    server.shutdown()


def test_jdbc(spark, tmp_path):
    from chatlake.sources import jdbc

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    df = spark.range(50).selectExpr("id", "cast(id * 2 as string) as v")
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "createTableColumnTypes": "v varchar(20)"}
    jdbc.write_table(df, url, "t", mode="overwrite", **opts)
    jdbc.write_table(df.filter("id < 3"), url, "t", **opts)
    read = {"driver": opts["driver"]}
    assert jdbc.read_table(spark, url, "t", **read).count() == 53
    parts = jdbc.read_table(spark, url, "t", "id", "0", "50", 4, **read)
    assert parts.rdd.getNumPartitions() == 4 and parts.filter("id >= 48").count() == 2
    jdbc.write_table(df.filter("id = 1"), url, "t", mode="overwrite", **opts)
    assert [r["v"] for r in jdbc.read_table(spark, url, "t", **read).collect()] == ["2"]
