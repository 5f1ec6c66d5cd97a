"""PDF to markdown with an injected reader: (content) -> markdown. A reader that fails, finds nothing or meets a file
over the limit gives way to the text layer, and the reason is kept.

The reader runs in a child process of the Spark worker, which is started once, says when it is ready and is then asked
file by file. A child that outlasts its deadline, or dies, is killed and started anew for the next file; native code
cannot keep it alive. After `MAX_STARTS` starts in a row that failed no more are tried."""

from __future__ import annotations

import multiprocessing
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

MAX_BYTES, SECONDS, START_SECONDS, MAX_STARTS = 50 * 1024 * 1024, 120, 180, 3
Read = Callable[[bytes], str]


def _serve(conn, load: Callable[[], Read]) -> None:
    try:
        read = load()
    except BaseException as e:
        conn.send(("failed", str(e)[:500]))
        return
    conn.send(("ready", None))
    while (content := conn.recv()) is not None:
        try:
            conn.send(("ok", read(content)))
        except Exception as e:  # the reader's own failure, whatever it is
            conn.send(("error", str(e)[:500]))


class Child:
    """A reader in a process of its own: a function that raises TimeoutError, or RuntimeError with the reader's words."""

    def __init__(self, load: Callable[[], Read], seconds: float = SECONDS, start_seconds: float = START_SECONDS):
        self.load, self.seconds, self.start_seconds = load, seconds, start_seconds
        self.process = self.conn = None
        self.failed, self.why = 0, ""

    @property
    def given_up(self) -> bool:
        return self.failed >= MAX_STARTS

    def _start(self) -> None:
        ctx = multiprocessing.get_context("fork")
        self.conn, there = ctx.Pipe()
        self.process = ctx.Process(target=_serve, args=(there, self.load), daemon=True)
        self.process.start()
        there.close()
        state, said = self._answer(self.start_seconds)
        if state != "ready":
            self.failed, self.why = self.failed + 1, said or state
            self.close()
            raise ChildProcessError(self.why)
        self.failed = 0

    def _answer(self, seconds: float) -> tuple[str, str | None]:
        try:
            return self.conn.recv() if self.conn.poll(seconds) else ("timeout", None)
        except (EOFError, OSError):
            return "died", None

    def __call__(self, content: bytes) -> str:
        if self.given_up:
            raise ChildProcessError(self.why)
        if self.process is None:
            self._start()
        self.conn.send(content)
        state, said = self._answer(self.seconds)
        if state == "ok":
            return said or ""
        if state != "error":
            self.close()
        if state == "timeout":
            raise TimeoutError
        raise RuntimeError(said or "the reader's process died")

    def close(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.conn.close()
        self.process = self.conn = None


def join_pages(pages: list[str]) -> str:
    return "\n\n".join(p.strip() for p in pages if p and p.strip())


def to_markdown(content: bytes, layout: Read | None, text_layer: Read | None) -> tuple[str | None, str, str | None, str | None]:
    """(markdown, backend, reason, error)."""
    reason = error = None
    if layout is None:
        reason = "startup"
    elif len(content) > MAX_BYTES:
        reason = "oversize"
    else:
        try:
            if (md := layout(content)) and md.strip():
                return md, "layout", None, None
            reason = "empty"
        except TimeoutError:
            reason = "timeout"
        except ChildProcessError as e:
            reason, error = "startup", str(e)[:500] or None
        except Exception as e:  # the reader's own failure, whatever it is
            reason, error = "conversion", str(e)[:500]
    if text_layer is not None:
        try:
            if (t := text_layer(content)) and t.strip():
                return t, "text_layer", reason, error
        except Exception as e:
            error = str(e)[:500]
    return None, "none", reason, error


def convert(df: DataFrame, key: str, content: str, load: Callable[[], tuple[Read | None, Read | None]], seconds: float = SECONDS, start_seconds: float = START_SECONDS) -> DataFrame:
    """(key, markdown, backend, reason, error) of each PDF. load gives the layout reader and the text layer's, either of
    which may be None; it runs once in each worker and once in each child that holds the layout reader."""

    def run(frames: Iterator[pd.DataFrame]):
        layout, layer = load()
        child = None if layout is None else Child(lambda: load()[0], seconds, start_seconds)
        try:
            for f in frames:
                if len(f):
                    r = [to_markdown(bytes(c), child, layer) for c in f["content"]]
                    yield pd.DataFrame({"key": f["key"].to_numpy(), **{n: [x[i] for x in r] for i, n in enumerate(("markdown", "backend", "reason", "error"))}}, dtype=object)
        finally:
            if child is not None:
                child.close()

    return df.selectExpr(f"cast({key} as string) as key", f"{content} as content").where("content is not null").mapInPandas(run, "key string, markdown string, backend string, reason string, error string")
