"""Messages of request logs that arrive in pieces: a message may be cut anywhere, over any number of micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Where a message begins: after a line end, or at the start of the log.
OPENS = '\n{"'
STATE = "next long, held string, waiting array<struct<at:long,text:string>>, ends long"


def _messages(held: str) -> tuple[list[str], str]:
    """Whole messages of held, which begins with a line end, and what is left: the last message so far, or what may be
    the start of one. Text before the first message is dropped."""
    first = held.find(OPENS)
    if first < 0:
        return [], held[-(len(OPENS) - 1) :]
    parts = held[first + 1 :].split(OPENS)
    whole = [parts[0], *('{"' + p for p in parts[1:])]
    return whole[:-1], "\n" + whole[-1]


def _assembled(key, pdfs: Iterator, state: GroupState) -> Iterator:
    import pandas as pd

    at, held, waiting, ends = state.get if state.exists else (0, "\n", [], -1)
    pieces = {p["at"]: p["text"] for p in waiting or []}
    for pdf in pdfs:
        for i, text in zip(pdf["at"].tolist(), pdf["text"].tolist(), strict=True):
            if text is None:
                ends = int(i)
            elif i >= at:  # else it was there before: a repeated piece counts once
                pieces[int(i)] = text
    out = []
    while (text := pieces.pop(at, None)) is not None:
        at += len(text)
        whole, held = _messages(held + text)
        out += whole
        if not text:
            break
    if at == ends and held:
        out += _messages(held + OPENS)[0]
        held = ""  # stands for a log that has ended, so that a piece that comes again isn't its start
    state.update((at, held, sorted(pieces.items()), ends))
    yield pd.DataFrame({"log": [key[0]] * len(out), "value": out})


def messages(pieces: DataFrame) -> DataFrame:
    """(log, value): the messages of logs, each when the next one begins or its log ends, for logs.parsed().

    pieces: a stream of (log, at, text): the log's name, how many characters of it come before, and the text; a null text
    says that the log ends at that place. Pieces of a log may come in any order and more than once; what comes early
    waits in the log's state, which else holds the message that is still open and, once the log has ended, its length. A log's text is one sequence, so it is one
    group; different logs are in different tasks, and a task sees one micro-batch of a log at a time. Empty pieces and
    logs without a message give nothing.
    """
    x = pieces.select(F.col("log").cast("string"), F.col("at").cast("long"), F.col("text").cast("string"))
    return x.groupBy("log").applyInPandasWithState(_assembled, "log string, value string", STATE, "append", GroupStateTimeout.NoTimeout)
