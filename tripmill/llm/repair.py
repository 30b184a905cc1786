"""Conversation structure repair: the cheapest edits that make turns alternate, by IDA*.

A repaired conversation has the role initials (s?(ua)+)?: perhaps a system turn, then user and
assistant turns by turns, or nothing at all. Edits go through a conversation's rows in order:

    D  delete a row              3, required of blank and duplicate rows
    I  insert an empty turn      2, user or assistant, anywhere
    K  keep a row                0
    R  give a row another role   2, user or assistant

A truncated row that is not deleted adds 1. The audit is the string of edits; of the cheapest it
is the least in ASCII order. The last emitted role decides which role may follow, so an audit
fixes every inserted and every changed role.

Iterative deepening: a depth-first search tries the edits in ASCII order under a bound on the
cost; if it fails, the bound rises to the least cost that passed it. Two lower bounds cut
branches: what the remaining rows cost whatever is done (deletions required, truncated rows) with
what their illegal neighbours cost, and what the table of failed states knows. The first path that
is accepted under the least bound that allows one is the answer. A conversation of more than BLOCK
rows is searched block by block, for every role to enter and to leave a block with; blocks are
joined by least cost and then least audit, which gives the same answer (see `repair`).

Memory of a task: two bytes a row and a 16-byte digest per different message of the conversation
at hand, never its texts; those stream past a second time, beside the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import arrow_rows, stored

#: Rows of a conversation that are searched at once.
BLOCK = 256
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Characters of a text that order rows of one turn and role before their digests do.
LEAD = 32

DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: What was emitted last; any other role initial is OTHER, which nothing may precede or follow.
NOTHING, SYSTEM, USER, ASSISTANT, OTHER = range(5)
SYMBOLS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The user or assistant turn that may follow.
FOLLOW = (USER, USER, ASSISTANT, USER)
LEGAL = ((USER, SYSTEM), (USER,), (ASSISTANT,), (USER,), ())
FINAL = (NOTHING, ASSISTANT)
FINE, GONE, TRUNCATED = range(3)
NEVER = 1 << 60  # the cost of a state that nothing leads on from

AUDITS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint,"
    " illegal bigint, cost bigint, audit string"
)
TURNS = "conv_id bigint, position bigint, role string, text string"
REPORTS = AUDITS + ", repaired_sha256 string"


# ---- one conversation


class _Search:
    """The cheapest edits of some rows, entered after `enter`. leave: the role to end with, None
    for the end of a conversation, where an assistant turn (or nothing) must stand and turns may
    be inserted behind the last row."""

    def __init__(self, symbols, faults, enter: int = NOTHING, leave: int | None = None):
        self.symbols, self.faults, self.enter, self.leave = symbols, faults, enter, leave
        self.n = n = len(symbols)
        # per row: cost that no edit avoids, the next row that stays, and of the pairs of
        # neighbours from that row on: length of the illegal chain at their head, cost behind it
        self.forced, self.next = [0] * (n + 1), [n] * (n + 1)
        self.chain, self.behind = [0] * (n + 1), [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            gone = faults[i] == GONE
            self.forced[i] = self.forced[i + 1] + (DELETE if gone else CUT * (faults[i] == TRUNCATED))
            if gone:
                self.next[i] = self.next[i + 1]
            else:
                self.next[i] = i
                self.chain[i], self.behind[i] = self._pair(symbols[i], self.next[i + 1])

    def _pair(self, symbol: int, k: int) -> tuple[int, int]:
        if k < self.n:
            legal = self.symbols[k] in LEGAL[symbol]
        else:
            legal = symbol in FINAL if self.leave is None else symbol == self.leave
        if legal:
            return 0, self.behind[k] + _chain_cost(self.chain[k])
        return self.chain[k] + 1, self.behind[k]

    def least(self, i: int, last: int) -> int:
        """A cost that the rows from i on need at least, after the role `last`.

        An edit changes at most two neighbouring pairs, so a chain of m illegal pairs needs
        (m + 1) // 2 edits of at least 2 each; a deletion costs one more, which covers that it
        may be of a truncated row.
        """
        chain, behind = self._pair(last, self.next[i])
        return self.forced[i] + behind + _chain_cost(chain)

    def edits(self, i: int, last: int) -> list[tuple[int, int, int, str]]:
        """(cost, next row, role then last, letter) in ASCII order."""
        out, row = [], i < self.n
        follow = FOLLOW[last]
        if row:
            out.append((DELETE, i + 1, last, "D"))
        if row or self.leave is None:
            out.append((INSERT, i, follow, "I"))
        if row and self.faults[i] != GONE:
            symbol, cut = self.symbols[i], CUT * (self.faults[i] == TRUNCATED)
            if symbol in LEGAL[last]:
                out.append((cut, i + 1, symbol, "K"))
            if symbol != follow:
                out.append((REROLE + cut, i + 1, follow, "R"))
        return out

    def run(self) -> tuple[int, str]:
        ends = FINAL if self.leave is None else (self.leave,)
        failed: dict[tuple[int, int], int] = {}  # what a state that failed needs at least
        bound = self.least(0, self.enter)
        while True:
            # row, role, spent, edits, the next of them, least need found, cost of getting here
            stack = [[0, self.enter, 0, self.edits(0, self.enter), 0, NEVER, 0]]
            path: list[str] = []
            while stack:
                frame = stack[-1]
                i, last, spent, edits, at, need, _ = frame
                if i == self.n and last in ends:
                    return bound, "".join(path)
                for at in range(at, len(edits)):
                    cost, j, role, letter = edits[at]
                    more = cost + max(self.least(j, role), failed.get((j, role), 0))
                    if spent + more <= bound:
                        frame[4], frame[5] = at + 1, need
                        path.append(letter)
                        stack.append([j, role, spent + cost, self.edits(j, role), 0, NEVER, cost])
                        break
                    need = min(need, more)
                else:
                    failed[i, last] = need
                    stack.pop()
                    if stack:
                        path.pop()
                        stack[-1][5] = min(stack[-1][5], need + frame[6])
            bound = failed[0, self.enter]


def _chain_cost(pairs: int) -> int:
    return INSERT * ((pairs + 1) // 2)


def _across(symbols, faults, enter: int) -> Iterator[tuple[int, int, str]]:
    """(role left with, cost, audit) of a block entered after `enter`, for each role possible."""
    n = len(symbols)
    if enter in (NOTHING, SYSTEM):  # only deletions leave these as they are
        yield enter, DELETE * n, "D" * n
    if enter == NOTHING:
        # one system row stays: an unbroken one if there is, the last of them as D comes before K
        kept = [(f == TRUNCATED, -i) for i, (x, f) in enumerate(zip(symbols, faults))
                if x == SYSTEM and f != GONE]
        if kept:
            cut, i = min(kept)
            yield SYSTEM, DELETE * (n - 1) + CUT * cut, "D" * -i + "K" + "D" * (n - 1 + i)
    for leave in (USER, ASSISTANT):
        yield leave, *_Search(symbols, faults, enter, leave).run()


def repair(symbols, faults, block: int = BLOCK) -> tuple[int, str]:
    """(cost, audit) of a conversation of any length.

    symbols, faults: one small integer per row. Insertions between two blocks belong to the
    later one, so the audits of a block all end with a row's letter and none is the head of
    another: the least joined audit consists of least parts.
    """
    paths = {NOTHING: (0, "")}
    for at in range(0, len(symbols) - block, block):
        part = symbols[at : at + block], faults[at : at + block]
        onward: dict[int, tuple[int, str]] = {}
        for enter, (cost, audit) in paths.items():
            for leave, more, letters in _across(*part, enter):
                path = cost + more, audit + letters
                onward[leave] = min(onward.get(leave, path), path)
        paths = onward
    at = max(0, -(-len(symbols) // block) - 1) * block
    found = []
    for enter, (cost, audit) in paths.items():
        more, letters = _Search(symbols[at:], faults[at:], enter).run()
        found.append((cost + more, audit + letters))
    return min(found)


def illegal_pairs(symbols) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    return sum(b not in LEGAL[a] for a, b in zip(symbols, symbols[1:]))


# ---- plan


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) with faults put in by the crc32 of conv_id:turn.

    Of twenty remainders 0 drops a row (it stays with present false and names its conversation),
    1 empties its text, 2 removes . ! and ?, 3 repeats it and 4 makes it the user's. A null is
    one space, in role, text and the key.
    """
    conv, turn = (
        F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")
    )
    key = F.concat(conv, F.lit(":"), turn)
    kind = F.col("kind")
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    ).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(
            F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0))
        ).alias("present"),
    )


def _rows(turns: DataFrame) -> DataFrame:
    """The columns that are read, with present where the input has none."""
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    # a dropped row only names its conversation: nothing else of it is carried
    shown = [F.when(present, c).alias(n) for n, c in (("turn", F.col("turn")), ("role", role), ("text", text))]
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), present.alias("present"), *shown)
    return rows.withColumns(
        {
            "turn": F.col("turn").cast("bigint"),
            "lead": F.substring("text", 1, LEAD),
            "digest": F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text"))),
        }
    )


def _last_ends(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1)).isin(*ENDS)


def audits(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost and audit.

    Rows go by turn, nulls first; rows of one turn by role, then by the first 32 characters of
    the text, then by its digest. Rows without conv_id form one conversation. A null role or text
    is one space. A row's first fault counts: blank (nothing but white space), duplicate (role
    and text came before), truncated (the last character that is no white space is not . ! or
    ?). A role other than system, user and assistant, told by its initial, can only be replaced
    or deleted. A row whose column present is false only names its conversation; without that
    column all rows count. gaps: turn numbers that are missing between the least and the greatest.
    A conversation without rows has zeros and an empty audit, an empty table no rows. Other
    columns are not read. Texts of any length stay behind: the shuffle moves digests.
    """
    facts = _rows(turns).select(
        "conv_id",
        "turn",
        "role",
        "lead",
        "digest",
        F.when(~F.col("present"), 0)
        .when(F.length(F.ltrim(F.col("text"), F.lit(SPACES))) == 0, 1)
        .when(_last_ends(F.col("text")), 2)
        .otherwise(3)
        .alias("state"),
        F.substring("role", 1, 1).alias("initial"),
    )
    order = ["conv_id", "turn", "role", "lead", "digest"]
    columns = ("conv_id", "turn", "state", "initial", "digest")

    def judge(batches):
        rows: list[tuple] = []
        open_ = None
        for batch in batches:
            for conv, turn, state, initial, digest in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                if open_ is None or open_.conv_id != conv:
                    if open_ is not None:
                        rows.append(open_.report(block))
                    open_ = _Facts(conv)
                if state:
                    open_.add(turn, state, initial, digest)
            if len(rows) >= 1024:
                yield arrow_rows(rows, AUDITS)
                rows = []
        if open_ is not None:
            rows.append(open_.report(block))
        yield arrow_rows(rows, AUDITS)

    ordered = facts.repartition("conv_id").sortWithinPartitions(*order)
    return ordered.select(*columns).mapInArrow(judge, AUDITS)


class _Facts:
    """What is kept of the conversation that streams through a task."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols, self.faults, self.seen = bytearray(), bytearray(), set()
        self.low = self.high = None
        self.turns = 0
        self.counts = [0, 0, 0]  # blank, duplicate, truncated

    def add(self, turn, state: int, initial: str, digest: bytes) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        again = digest in self.seen
        self.seen.add(digest)
        fault = FINE
        if state == 1 or again:
            fault = GONE
            self.counts[0 if state == 1 else 1] += 1
        elif state == 3:
            fault = TRUNCATED
            self.counts[2] += 1
        self.symbols.append(SYMBOLS.get(initial, OTHER))
        self.faults.append(fault)

    def report(self, block: int) -> tuple:
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        cost, audit = repair(self.symbols, self.faults, block)
        return self.conv_id, gaps, *self.counts, illegal_pairs(self.symbols), cost, audit


def _applied(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order."""
    none = [F.lit(None).cast(kind).alias(c) for c, kind in
            (("turn", "bigint"), ("role", "string"), ("lead", "string"), ("digest", "binary"))]
    names = [f.split()[0] for f in AUDITS.split(",")][1:-1]
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), *none, F.col("audit").alias("text"),
        F.array(*names).alias("numbers"),
    )
    rows = _rows(turns).filter("present").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "lead", "digest", "text",
        F.lit(None).cast("array<bigint>").alias("numbers"),
    )
    order = ["conv_id", "kind", "turn", "role", "lead", "digest"]
    both = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "kind", "role", "text", "numbers")


def _edited(batches) -> Iterator[tuple]:
    """(conv_id, numbers, audit) as a conversation begins, (role, text) per repaired turn."""
    audit, at, last = "", 0, NOTHING

    def inserted():
        nonlocal at, last
        while at < len(audit) and audit[at] == "I":
            at, last = at + 1, FOLLOW[last]
            yield ROLES[last], ""

    for batch in batches:
        columns = ("conv_id", "kind", "role", "text", "numbers")
        for conv, kind, role, text, numbers in zip(*(batch.column(c).to_pylist() for c in columns)):
            if kind == 0:
                yield from inserted()  # behind the last row of the conversation before
                audit, at, last = text, 0, NOTHING
                yield conv, numbers, audit
                continue
            yield from inserted()
            letter, at = audit[at], at + 1
            if letter == "K":
                last = SYMBOLS[role[0]]
                yield role, text
            elif letter == "R":
                last = FOLLOW[last]
                yield ROLES[last], text
    yield from inserted()


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations, positions from 1.

    found: audits(turns). Inserted turns have an empty text.
    """

    def turn_rows(batches):
        conv, position, rows = None, 0, []
        for item in _edited(batches):
            if len(item) == 3:
                conv, position = item[0], 0
                continue
            position += 1
            rows.append((conv, position, *item))
            if len(rows) >= 512:
                yield arrow_rows(rows, TURNS)
                rows = []
        yield arrow_rows(rows, TURNS)

    return _applied(turns, found).mapInArrow(turn_rows, TURNS)


def reports(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """audits, with the SHA-256 of each repaired conversation's `role:text`, newline-joined.

    Empty for a conversation of which nothing is left, whose digest is that of no bytes. The
    audits are written first, then every conversation streams past its own.
    """
    found = stored(audits(turns, block), "audits")

    def digest(batches):
        head, sha, first, rows = None, None, True, []
        for item in _edited(batches):
            if len(item) == 3:
                if head is not None:
                    rows.append((*head, sha.hexdigest()))
                    if len(rows) >= 1024:
                        yield arrow_rows(rows, REPORTS)
                        rows = []
                conv, numbers, audit = item
                head, sha, first = (conv, *numbers, audit), hashlib.sha256(), True
                continue
            role, text = item
            sha.update(f"{'' if first else chr(10)}{role}:".encode())
            sha.update(text.encode())
            first = False
        if head is not None:
            rows.append((*head, sha.hexdigest()))
        yield arrow_rows(rows, REPORTS)

    return _applied(turns, found).mapInArrow(digest, REPORTS)
