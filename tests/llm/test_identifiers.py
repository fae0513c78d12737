"""Identifiers of conversations of any type, and widths of token ids that follow the vocabulary."""

import json

import pytest
from corvane.llm import chat, queries, tokenbin


@pytest.mark.parametrize("kind", ["string", "long", "int"])
def test_conversations_keep_the_type_of_their_identifier(spark, kind):
    ids = {"string": ("5c1f-uuid", "b", None), "long": (1 << 40, 2, None), "int": (7, 8, None)}[kind]
    rows = [(i, t, *x) for i in ids for t, x in enumerate([("user", "hi"), ("assistant", '<tool_call>{"id":"c","name":"f","arguments":{}}</tool_call>'), ("tool", '{"tool_call_id":"c","content":"x"}')])]
    out = chat.format_chats(spark.createDataFrame(rows, f"conv_id {kind}, turn long, role string, text string"))
    assert out.schema["conv_id"].dataType.simpleString() == {"long": "bigint"}.get(kind, kind)
    got = {r["conv_id"]: (r["n_turns"], r["n_linked"], json.loads(r["text"])[2]["name"]) for r in out.collect()}
    assert got == dict.fromkeys(ids, (3, 1, "f"))


def test_token_width_follows_the_vocabulary(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some text"), (2, "more")], "doc_id long, text string")
    path = queries.tokenizer_path("byte_bpe_50k.json")
    tokens = {}
    for name, options in (("own", {}), ("given", {"vocabulary": 1 << 17}), ("end", {"end_id": 70_000})):
        folder = f"file://{tmp_path}/{name}"
        rows = tokenbin.token_files(docs, path, folder, **({"end_id": 2} | options)).collect()
        tokens[name] = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows)
        shard = tokenbin.Shard(next(p for p in map(str, (tmp_path / name).glob("*.tok"))))
        assert shard.ids.dtype.itemsize == (2 if name == "own" else 4)
        assert int(shard.document(0)[-1]) == options.get("end_id", 2)
    assert tokens["own"] == tokens["given"] and tokens["end"] != tokens["own"]


def test_ids_beyond_the_width_stop_the_job(spark, tmp_path, monkeypatch):
    """A vocabulary that is told too small is found out where the ids are written."""
    plain = tokenbin.encoder

    class Wide:
        def __init__(self, path):
            self.own = plain(path)

        def encode_column(self, column):
            ids, bounds = self.own.encode_column(column)
            return ids + 70_000, bounds

    def one_task(df, f, schema):  # the writer alone, in this process
        from unittest import mock

        with mock.patch("pyspark.TaskContext.get") as context:
            context.return_value.partitionId.return_value = 0
            return list(f(iter([b for b in df.toArrow().to_batches() if b.num_rows])))

    monkeypatch.setattr(tokenbin, "encoder", Wide)
    monkeypatch.setattr(tokenbin, "by_arrow", one_task)
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    with pytest.raises(ValueError, match="beyond a vocabulary"):
        tokenbin.write_shards(docs, queries.tokenizer_path("byte_bpe_50k.json"), f"file://{tmp_path}/w", vocabulary=50_257)
