"""Messages put together from any pieces in any micro-batches equal the batch parse."""

import json
import random

import pytest

from axonlake.operators import logs
from axonlake.streaming import log_messages

from .test_sources import log


def cut(text, r, most):
    at, out = 0, []
    while at < len(text):
        n = r.randrange(1, most)
        out.append((at, text[at : at + n]))
        at += n
    return out + [(len(text), None)]


@pytest.mark.parametrize("most, files, shuffled", [(9, 6, False), (400, 5, False), (60, 4, True), (10**6, 1, False)])
def test_stream_equals_batch(spark, tmp_path, most, files, shuffled):
    r = random.Random(most)
    texts = {"a": "\n".join(log(25, most)), "b": 'the end of another {"\n' + "\n".join(log(12, 77)) + "\n", "c": "no message at all\n{x"}
    rows = [{"log": k, "at": at, "text": t} for k, v in texts.items() for at, t in cut(v, r, most)]
    if shuffled:
        r.shuffle(rows)
        rows += rows[:20] + [x for x in rows if x["at"] == 0]
    (tmp_path / "in").mkdir()
    for f in range(files):  # micro-batches
        part = rows[len(rows) * f // files : len(rows) * (f + 1) // files]
        (tmp_path / "in" / f"{f:03}.json").write_text("\n".join(map(json.dumps, part)))
    s = spark.readStream.schema("log string, at long, text string").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = log_messages.messages(s).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    for k, v in texts.items():
        (tmp_path / k).write_text(v)
    key = lambda df: sorted((x.time, x.uri, x.user, x.debug) for x in df.collect())
    got = spark.read.parquet(f"{tmp_path}/out")
    for k in texts:
        assert key(logs.parsed(got.where(f"log = '{k}'"))) == key(logs.parsed(logs.messages(spark, str(tmp_path / k)))), k
    assert got.where("log = 'c'").count() == 0
    last = lambda df: sorted(map(tuple, logs.last_per_user(logs.parsed(df), "user", ("time",)).select("user", "time", "requests").collect()))
    assert last(got.where("log = 'a'")) == last(logs.messages(spark, str(tmp_path / "a")))


def test_open_message_waits_for_its_end():
    assert log_messages._messages('\nab\n{"x": 1\n {"y\n{"z') == (['{"x": 1\n {"y'], '\n{"z')
    assert log_messages._messages("\n{") == ([], "\n{") and log_messages._messages("abc\n") == ([], "c\n")
