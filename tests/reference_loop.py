"""Row-at-a-time accounts of what the operators must give, for comparison on small inputs."""

from __future__ import annotations

import re


def clean(cell):
    return (cell or "").strip(" \t\n\r\x0b\x00")


def valid(number):
    return re.fullmatch("255[0-9]{9}", number) is not None


def plan(cells, chunk, batch, ports):
    """One tuple (msisdn, pos, chunk_no, chunk_pos, batch_no, port) per valid cell, by filling chunks in turn."""
    chunks, filling = [], []
    for cell in cells:
        number = clean(cell)
        if not valid(number):
            continue
        filling.append(number)
        if len(filling) == chunk:
            chunks.append(filling)
            filling = []
    if filling:
        chunks.append(filling)
    rows, pos = [], 0
    for chunk_no, numbers in enumerate(chunks, start=1):
        for start in range(0, len(numbers), batch):
            for key, number in enumerate(numbers[start : start + batch]):
                rows.append((number, pos, chunk_no, start + key, start // batch, ports[(start + key) % len(ports)]))
                pos += 1
    return rows


def totals(rows):
    """Issued, counted, sent, failed of (batch, msisdn, errno) rows: a repeat in a batch replaces the one before."""
    batches: dict = {}
    issued = 0
    for batch, number, errno in rows:
        batches.setdefault(batch, {})[number] = errno
        issued += 1
    results = [errno for handles in batches.values() for errno in handles.values()]
    sent = sum(1 for errno in results if errno == 0)
    return issued, len(results), sent, len(results) - sent
