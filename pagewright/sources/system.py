"""Samples of this machine: limits and use of processor and memory. Runs where it is called, on the driver."""

from __future__ import annotations

import os
import time
from pathlib import Path

#: A limit from here on means none.
NO_LIMIT = 1 << 60


def limit(text: str) -> int | None:
    """A limit in bytes as control groups write it."""
    text = text.strip()
    if text == "max" or not text.isdigit() or int(text) >= NO_LIMIT:
        return None
    return int(text)


def cpu_capacity(quota: str, cores: int) -> float:
    """Cores that may be used, from 'quota period' or 'max period'."""
    parts = quota.split()
    if len(parts) == 2 and parts[0].isdigit() and parts[1].isdigit() and int(parts[1]) > 0:
        return min(float(cores), int(parts[0]) / int(parts[1]))
    return float(cores)


def process_sample(pid: int, proc: str = "/proc") -> tuple[float, int]:
    """(processor seconds, resident bytes) of a process and all below it; processes that end meanwhile count as nothing."""
    ticks, page = os.sysconf("SC_CLK_TCK"), os.sysconf("SC_PAGE_SIZE")
    children: dict[int, list[int]] = {}
    seen: dict[int, tuple[float, int]] = {}
    for p in Path(proc).iterdir():
        if p.name.isdigit():
            try:
                rest = (p / "stat").read_text().rpartition(")")[2].split()
            except OSError:
                continue
            children.setdefault(int(rest[1]), []).append(int(p.name))
            seen[int(p.name)] = ((int(rest[11]) + int(rest[12])) / ticks, int(rest[21]) * page)
    todo, done, cpu, memory = [pid], set(), 0.0, 0
    while todo:
        at = todo.pop()
        if at in done:
            continue
        done.add(at)
        c, m = seen.get(at, (0.0, 0))
        cpu, memory = cpu + c, memory + m
        todo += children.get(at, [])
    return cpu, memory


class Sampler:
    """Writes a sample every period, as one JSON file each, into a folder that a stream reads; the last on stopping."""

    def __init__(self, folder: str, run_id: int = 1, period: float = 1.0):
        import threading

        self.folder, self.run_id, self.period, self.seq = Path(folder), run_id, period, 0
        self._stop, self._began = threading.Event(), time.monotonic()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def __enter__(self) -> Sampler:
        self._thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self._stop.set()
        self._thread.join()

    def _run(self) -> None:
        while True:
            last = self._stop.wait(0 if self.seq == 0 else self.period)
            self._write()
            if last:
                return

    def _write(self) -> None:
        import json

        self.seq += 1
        cpu, memory = process_sample(os.getpid())
        row = {"run_id": self.run_id, "seq": self.seq, "elapsed_us": int((time.monotonic() - self._began) * 1e6), "cpu_hundredths": int(cpu * 100), "memory_bytes": memory}
        temp = self.folder / f".{self.run_id}-{self.seq}"
        temp.write_text(json.dumps(row) + "\n")
        temp.replace(self.folder / f"{self.run_id}-{self.seq:09d}.json")
