import hashlib
import json
import uuid

import pytest
from pyspark.sql import functions as F

from chatlake import constants as K
from chatlake.functions import ids, jsonx, text, vector


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw", ["agent-a04b965", "süß", "", "x" * 300])
def test_uuid5(spark, raw):
    assert one(spark, raw, ids.conversation_id) == str(uuid.uuid5(uuid.UUID(K.ID_NAMESPACE), raw))


def test_uuid_is_kept(spark):
    u = str(uuid.uuid4())
    assert one(spark, u, ids.conversation_id) == u
    assert one(spark, u.replace("-", ""), ids.conversation_id) == u.replace("-", "")
    assert one(spark, "{" + u.upper() + "}", ids.conversation_id) == "{" + u.upper() + "}"


@pytest.mark.parametrize(("folder", "path"), [("-home-u-x", "/home/u/x"), ("plain-x", "plain-x"), ("-", "/"), (None, None)])
def test_project_path(spark, folder, path):
    assert one(spark, folder, ids.project_path) == path


def test_tree_id(spark):
    rec = {"mapping": {"b": {"é": 1}, "a": None}}
    want = hashlib.sha256(json.dumps(rec["mapping"], sort_keys=True).encode()).hexdigest()[:32]
    assert one(spark, json.dumps(rec), ids.tree_conversation_id) == want
    assert one(spark, '{"id": "k", "mapping": {}}', ids.tree_conversation_id) == "k"
    assert one(spark, '{"id": null, "mapping": {}}', ids.tree_conversation_id) is None
    assert one(spark, "no json", ids.tree_conversation_id) is None


@pytest.mark.parametrize("n", [0, 1, 5999, 6000, 6001, 11700, 11701, 17400, 17401, 30000])
def test_pieces(spark, n):
    t = "".join(chr(97 + i % 26) for i in range(n))
    want, start = [], 0
    if n <= 6000:
        want = [t]
    while n > 6000 and start < n - 300:
        want.append(t[start : start + 6000])
        start += 5700
    assert one(spark, t, text.pieces) == want


def test_truncate(spark):
    assert one(spark, "a" * 24000, text.truncate) == "a" * 24000
    assert one(spark, "a" * 24001, text.truncate) == "a" * 24000 + K.CUT_MARK
    assert one(spark, "", text.for_model) == " "


def test_hash(spark):
    for t in ("", "é", "x" * 9999):
        assert one(spark, t, text.content_hash) == hashlib.sha256(t.encode()).hexdigest()[:32]
    assert one(spark, None, text.content_hash) == hashlib.sha256(b"").hexdigest()[:32]


def test_blocks(spark):
    f = lambda c: text.blocks_text(F.from_json(c, text.BLOCKS))
    blocks = [{"type": "text", "text": "a"}, {"type": "thinking", "text": "b"}, {"type": "tool_use"}, {"text": "c"}, {"type": "text", "text": ""}]
    assert one(spark, json.dumps(blocks), f) == "a\n\n[thinking] b\n\nc"
    assert one(spark, None, f) == ""


def test_parts(spark):
    f = lambda c: text.parts_text(F.from_json(c, "array<variant>"))
    parts = ["a", "", {"content_type": "image", "asset_pointer": "sediment://f"}, {"content_type": "x", "text": "t"}, 3, None, "b"]
    assert one(spark, json.dumps(parts), f) == "a\n\nt\nb"
    g = lambda c: F.to_json(text.parts_assets(F.from_json(c, "array<variant>")))
    assert json.loads(one(spark, json.dumps(parts), g))[0]["asset_pointer"] == "sediment://f"


def test_nul(spark):
    assert one(spark, r'{"a":"x\u0000y","b":"\\u0000"}', text.strip_nul_json) == r'{"a":"xy","b":"\\u0000"}'


def test_blobs(spark):
    t = 'x "data": "' + "A" * 1000 + '" y "data":"short"'
    assert one(spark, t, text.strip_blobs) == 'x "data": "[base64 removed]" y "data":"short"'


@pytest.mark.parametrize(("t", "blank"), [(None, True), ("", True), (" \t\n 　", True), ("​", False), (" a ", False)])
def test_blank(spark, t, blank):
    assert one(spark, t, text.is_blank) is blank


def test_content_type(spark):
    assert one(spark, "a/b.PNG", text.content_type) == "image/png"
    assert one(spark, "a.bin", text.content_type) == K.DEFAULT_CONTENT_TYPE
    assert one(spark, "noext", text.content_type) == K.DEFAULT_CONTENT_TYPE


def test_times(spark):
    f = lambda c: jsonx.record_time(c).cast("string")
    assert one(spark, '{"timestamp":"2024-01-02T03:04:05.678Z"}', f) == "2024-01-02 03:04:05.678"
    assert one(spark, '{"timestamp":"2024-01-02T03:04:05"}', f) == "2024-01-02 03:04:05"
    assert one(spark, '{"timestamp":1700000000123}', f) == "2023-11-14 22:13:20.123"
    for bad in ('{"timestamp":0}', "{}", '{"timestamp":"soon"}', '{"timestamp":[1]}', "no"):
        assert one(spark, bad, f) is None
    assert one(spark, "1700000000.5", lambda c: jsonx.epoch_time(c).cast("string")) == "2023-11-14 22:13:20.5"
    assert one(spark, "0", jsonx.epoch_time) is None


def test_content_paths(spark):
    assert one(spark, '{"content":[{"text":"t"}]}', jsonx.content_for_store) == "t"
    assert one(spark, '{"text":"u"}', jsonx.content_for_store) == "u"
    assert one(spark, '{"b":1,"a":2}', jsonx.content_for_vector) == '{"a":2,"b":1}'
    assert one(spark, "{}", jsonx.content_for_topic) == ""
    assert one(spark, '{"c":{"type" : "image"}}', jsonx.has_image) is True


def test_metadata(spark):
    f = lambda c: jsonx.filled_only(attachments=F.get_json_object(c, "$.attachments"), files=F.get_json_object(c, "$.files"))
    assert one(spark, '{"attachments":[],"files":[{"n":1}]}', f) == '{"files":[{"n":1}]}'
    assert one(spark, "{}", f) == "{}"


def test_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 3.0]), ("a", [3.0, 5.0]), ("b", [1.0, 3.0]), ("c", None)], "k string, v array<double>")
    assert {r["k"]: r["vector"] for r in vector.mean_vectors(df, "k", "v").collect()} == {"a": [2.0, 4.0], "b": [1.0, 3.0]}
    co = {r["k"]: r["coherence"] for r in vector.coherence(spark.createDataFrame([("a", [1.0, 0.0])] * 2 + [("b", [1.0, 1.0]), ("z", [0.0, 0.0]), ("z", [1.0, 0.0])], "k string, v array<double>"), "k", "v").collect()}
    assert co["a"] == pytest.approx(1) and co["b"] is None and co["z"] == pytest.approx(0)
    pair = spark.createDataFrame([([0.0], [1.0]), ([1.0, 2.0], [1.0]), ([3.0], [2.0])], "a array<double>, b array<double>").select(vector.cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert [r["c"] for r in pair] == [None, None, 1.0]
