"""Cheapest edits that make a sequence of turns follow ``(s?(ua)+)?``.

A turn is a symbol: ``s``, ``u``, ``a`` or ``o`` (another role), upper case
where its text is cut off (one more unless deleted), ``x`` where it must be
deleted. Edits: Keep 0, Rerole to u or a 2, Delete 3, Insert u or a 2. The
audit is the edits' initials in order; of equal costs the ASCII-least counts.

Turns are aligned to target strings of every feasible length by
Wagner-Fischer tables of suffix costs. All targets with the same last letter
share their tails, so one table, indexed by the turns that are left and the
letters that are left, holds the alignments to all lengths; a leading ``s``
adds one table. Cells lie in an Ukkonen band: the incumbent, a greedy repair,
costs so much more than what no repair can avoid, and a cell off the diagonal
by k costs 2 k more. Each length of least cost is backtraced, D before I
before K before R, and the audits are compared.

Long sequences are aligned in chunks. Between chunks only the place in the
grammar matters: 0 nothing yet, 1 after ``s``, 2 after ``u``, 3 after ``a``.
A chunk gives the cheapest audit from each place to each other one, with
inserts before the turn that follows them, so an audit ends with a turn. Two
audits of a chunk that end in different places then differ at some turn within
it, none is the beginning of the other, and the least choice at each chunk
gives the least audit of all.
"""

from __future__ import annotations

from functools import lru_cache

CHUNK = 64
_OTHER = {"u": "a", "a": "u"}
_FAR = 1 << 60
#: place: the letter that must come next there
_NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
_ENDS = {2: "u", 3: "a"}


class _Tables:
    """Suffix costs of the turns to targets that end with ``end``; ``done``:
    the sequence ends here, so inserts may follow the last turn."""

    def __init__(self, symbols: str, weights: tuple[int, ...], end: str, slack: int, done: bool):
        self.symbols, self.weights, self.end, self.done = symbols, weights, end, done
        n = len(symbols)
        live = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            live[i] = live[i + 1] + (symbols[i] != "x")
        self.low = [max(0, k - slack) for k in live]
        self.high = [k + slack for k in live]
        self.tail: list[list[int]] = [[]] * (n + 1)
        self.tail[n] = [(2 * r if done else 0 if r == 0 else _FAR) for r in range(self.low[n], self.high[n] + 1)]
        for i in range(n - 1, -1, -1):
            row, before = [], _FAR
            for r in range(self.low[i], self.high[i] + 1):
                before = min(self._delete(i) + self.at(i + 1, r), self._use(i, r), before + 2)
                row.append(before)
            self.tail[i] = row

    def at(self, i: int, r: int) -> int:
        k = r - self.low[i]
        return self.tail[i][k] if 0 <= k < len(self.tail[i]) else _FAR

    def letter(self, r: int) -> str:
        return self.end if r % 2 else _OTHER[self.end]

    def _delete(self, i: int) -> int:
        return 3 * self.weights[i]

    def _use(self, i: int, r: int) -> int:
        """Keep or rerole turn i as the first of r letters."""
        c = self.symbols[i]
        if c == "x" or r == 0:
            return _FAR
        return (0 if c.lower() == self.letter(r) else 2) + c.isupper() + self.at(i + 1, r - 1)

    def audit(self, i: int, r: int) -> str:
        out, n = [], len(self.symbols)
        while i < n or r:
            cost = self.at(i, r)
            if i < n and self._delete(i) + self.at(i + 1, r) == cost:
                out.append("D")
                i += 1
            elif (i < n or self.done) and r and self.at(i, r - 1) + 2 == cost:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.symbols[i].lower() == self.letter(r) else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    def leading(self, r: int) -> tuple[int, str | None]:
        """Cost and audit where an ``s`` is kept before r letters: all turns
        before it go; of equal costs the latest such turn."""
        best, at, gone = _FAR, None, 0
        for i, c in enumerate(self.symbols):
            if c in "sS":
                cost = gone + (c == "S") + self.at(i + 1, r)
                if cost <= best:
                    best, at = cost, i
            gone += self._delete(i)
        return best, None if at is None or best >= _FAR else "D" * at + "K" + self.audit(at + 1, r)


def _slack(symbols: str, place: int) -> int:
    """How far from the diagonal the cheapest alignment can lie: a greedy
    repair keeps what fits and reroles the rest; four more bring it to any end."""
    extra = 4
    for c in symbols.lower():
        if c == "x":
            continue
        if place == 0 and c == "s":
            place = 1
            continue
        extra += 2 * (c != _NEXT[place])
        place = 3 if place == 2 else 2
    return extra // 2


def _to(symbols: str, weights: tuple[int, ...], place: int, end: str, slack: int, done: bool, tables: _Tables | None = None) -> tuple[int, str] | None:
    t = tables or _Tables(symbols, weights, end, slack, done)
    stays = _ENDS.get(place) == end
    found = []
    for r in range(t.low[0], t.high[0] + 1):
        if (r > 0 and t.letter(r) == _NEXT[place]) or (r == 0 and stays):
            found.append((t.at(0, r), r))
    best = min((c for c, _ in found), default=_FAR)
    audits = [t.audit(0, r) for c, r in found if c == best < _FAR]
    if place == 0 and ("s" in symbols or "S" in symbols):
        led = []
        for r in range(max(1, t.low[0] - 1), t.high[0] + 1):
            if t.letter(r) == "u":
                led.append(t.leading(r))
        least = min((c for c, _ in led), default=_FAR)
        if least < _FAR and least <= best:
            audits = (audits if least == best else []) + [a for c, a in led if c == least]
            best = least
    return (best, min(audits)) if audits else None


def close(symbols: str, weights: tuple[int, ...], place: int = 0) -> tuple[int, str]:
    """(cost, audit) of the last turns of a sequence, from ``place``. A turn's
    weight is the number of equal turns it stands for (1 unless ``x``)."""
    best = _to(symbols, weights, place, "a", _slack(symbols, place), True)
    gone = (3 * sum(weights), "D" * len(symbols))
    return min(best, gone) if best and place == 0 else gone if not best else best


def through(symbols: str, weights: tuple[int, ...]) -> list[list[tuple[int, str] | None]]:
    """``[p][q]``: (cost, audit) of turns in between, from place p to q."""
    all_gone = (3 * sum(weights), "D" * len(symbols))
    out: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    out[0][0] = out[1][1] = all_gone
    s = [i for i, c in enumerate(symbols) if c in "sS"]
    if s:
        i = min(s, key=lambda i: (symbols[i] == "S", -i))
        out[0][1] = (all_gone[0] - 3 + (symbols[i] == "S"), "D" * i + "K" + "D" * (len(symbols) - i - 1))
    slack = max(_slack(symbols, p) for p in range(4))
    for q, end in _ENDS.items():
        tables = _Tables(symbols, weights, end, slack, False)
        for p in range(4):
            out[p][q] = _to(symbols, weights, p, end, slack, False, tables)
    return out


def behind(chunks: list, after: list[int]) -> list[list[int]]:
    """Costs from each place at the beginning of each chunk to the end, where
    ``after`` holds them behind the last; chunks as ``through`` gives them."""
    out = [after]
    for m in reversed(chunks):
        out.append([min((m[p][q][0] + out[-1][q] for q in range(4) if m[p][q]), default=_FAR) for p in range(4)])
    return out[::-1]


def choice(m: list, p: int, after: list[int]) -> int:
    """The place to which the least audit of a chunk leads from p."""
    options = [(m[p][q][0] + after[q], m[p][q][1], q) for q in range(4) if m[p][q]]
    return min(options)[2] if options else p


@lru_cache(maxsize=1 << 16)
def _whole(symbols: str) -> tuple[int, str]:
    return close(symbols, (1,) * len(symbols))


def align(symbols: str, chunk: int = CHUNK) -> tuple[int, str]:
    """(cost, audit) of a whole sequence."""
    if len(symbols) <= chunk:
        return _whole(symbols) if symbols else (0, "")
    parts = [symbols[k:k + chunk] for k in range(0, len(symbols), chunk)]
    middle = [through(x, (1,) * len(x)) for x in parts[:-1]]
    last = [close(parts[-1], (1,) * len(parts[-1]), p) for p in range(4)]
    costs = behind(middle, [c for c, _ in last])
    p, audit = 0, []
    for m, after in zip(middle, costs[1:], strict=True):
        q = choice(m, p, after)
        audit.append(m[p][q][1])
        p = q
    return costs[0][0], "".join(audit) + last[p][1]
