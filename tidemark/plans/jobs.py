"""Runs by mode: collect or replay, synchronise, verify, commit; states, frozen requests and outcomes."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schema
from ..operators import canonical, collect, replay, staging, sync, verify
from ..operators.windows import may_advance
from ..sources import crawl
from .store import Store, settled

#: Which state may follow which.
NEXT = {
    "PENDING": {"PREPARING", "COLLECTING", "FAILED"}, "PREPARING": {"COLLECTED", "FAILED"}, "COLLECTING": {"COLLECTED", "FAILED"}, "COLLECTED": {"SYNCING", "FAILED"},
    "SYNCING": {"VERIFYING", "FAILED"}, "VERIFYING": {"COMPLETED", "COMPLETED_WITH_ERRORS", "FAILED"}, "FAILED": set(), "COMPLETED": set(), "COMPLETED_WITH_ERRORS": set(),
}
EXIT = {"COMPLETED": 0, "FAILED": 1, "COMPLETED_WITH_ERRORS": 2, "ALREADY_COMPLETED": 3}

#: Whole forms of what a request may hold.
REQUEST_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,99}")
IDENTITY = {
    "source": re.compile(r"[A-Za-z0-9_-]{1,64}"), "source_execution": re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"), "rows": re.compile(r"[1-9][0-9]{0,11}"), "seed": re.compile(r"[0-9]{1,18}"),
    "until": re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})"), "since": re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})"),
    "bootstrap": re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})"),
}


@dataclass
class Request:
    """What identifies a run; tuning doesn't."""

    request_id: str
    mode: str
    identity: dict = field(default_factory=dict)
    contract: str = schema.CONTRACT_HASH

    def __post_init__(self):
        if self.mode not in schema.MODES:
            raise ValueError(f"unknown mode: {self.mode}")
        if not REQUEST_ID.fullmatch(self.request_id):
            raise ValueError("a request id has 1 to 100 letters, digits, dots, dashes and underscores, a letter or digit first")
        for name, form in IDENTITY.items():
            if (value := self.identity.get(name)) is not None and not form.fullmatch(str(value)):
                raise ValueError(f"{name} is not well formed")
        if self.contract != schema.CONTRACT_HASH:
            raise ValueError("the request was made for another canonical form")

    @property
    def execution_id(self) -> str:
        return str(uuid.UUID(bytes=hashlib.md5(f"{self.mode}|{self.request_id}".encode()).digest(), version=3))


def moved(now: str, to: str) -> str:
    if to not in NEXT[now]:
        raise ValueError(f"{now} can't become {to}")
    return to


def open_errors(store: Store, outcomes: DataFrame, at: dict) -> tuple[DataFrame, int]:
    """An open error for every row in conflict, numbered after all errors of the store, and the last number."""
    top = at["facts"].get("top_error")
    if top is None:
        top = store.read("errors", schema.ERRORS, at).agg(F.coalesce(F.max("error_key"), F.lit(0))).first()[0]
    found = settled(sync.conflict_errors(outcomes))
    numbered = staging.dense_sequence(found, ["execution_id", "staging_key"], "error_key", top, settled)
    return numbered.withColumns({"message": F.lit("same time, different content"), "created_at": F.current_timestamp(), "resolved_at": F.lit(None).cast("timestamp")}), top + found.count()


class Run:
    """One execution in a store. Each step commits by itself; a restart goes on after the last one committed."""

    def __init__(self, store: Store, request: Request, chunk_size: int = schema.CHUNK_SIZE):
        self.store, self.request, self.chunk_size = store, request, chunk_size
        self.id = request.execution_id

    def state(self, at: dict | None = None) -> dict:
        return (at or self.store.manifest())["facts"].get(f"run:{self.id}", {})

    def _fact(self, at: dict | None = None, **more) -> dict:
        return {f"run:{self.id}": {**self.state(at), **more}}

    def _read(self, name: str, shape, at: dict) -> DataFrame:
        """This execution's rows of a table: of folders committed for it, or for none alone."""
        return self.store.read(name, shape, at, self.id).where(F.col("execution_id") == self.id)

    def step(self, name: str, work, *args, **more):
        """work(...), with its begin and end kept among the run's facts, also where it fails."""
        began = datetime.now(UTC).isoformat()
        try:
            return work(*args, **more)
        finally:
            times = [began, datetime.now(UTC).isoformat()]
            self.store.transact(lambda at: self.store.commit(facts=self._fact(at, steps={**self.state(at).get("steps", {}), name: times}), base=at))

    def begin(self) -> str | None:
        """Freezes the request; ALREADY_COMPLETED for a run that has ended well, an error for a changed request."""
        have = self.state()
        if have and have["request"] != asdict(self.request):
            raise ValueError(f"request {self.request.request_id} was frozen with other terms")
        if have.get("status") in ("COMPLETED", "COMPLETED_WITH_ERRORS"):
            return "ALREADY_COMPLETED"
        if have.get("status") == "FAILED":
            raise ValueError("a failed verdict stands; make a new request")
        if not have:
            started = datetime.now(UTC).isoformat()
            mark, asked = self.store.manifest()["facts"].get(f"mark:{self.request.identity.get('source', 'default')}"), self.request.identity.get("since")
            if self.request.mode == "INCREMENTAL" and mark and asked and datetime.fromisoformat(mark) != datetime.fromisoformat(asked):
                raise ValueError(f"the range would begin at {asked}, but the mark is at {mark}")
            frozen = {"since": mark or asked or self.request.identity.get("bootstrap"), "until": self.request.identity.get("until") or started} if self.request.mode == "INCREMENTAL" else {}
            self.store.commit({}, self._fact(request=asdict(self.request), status="PENDING", started=started, **frozen))
        return None

    def evidence(self, pages: DataFrame) -> None:
        """Keeps what a log of pages(window_id, page_no, items, new_rows, total_results) says on the run's facts: window by window, and together."""
        total = collect.reported_total(pages).first().asDict()
        windows = [r.asDict() for r in collect.window_evidence(pages).orderBy("window_id").collect()]  # a row for each window of a plan
        self.store.commit({}, self._fact(collected={**total, "by_window": windows}))

    def collect(self, plan: list[tuple[str, str]], limit: int | None = None, pages_a_round: int = 20, cap: int = schema.PAGE_CAP, **options: str) -> None:
        """Reads a plan's windows in rounds and stages their records; each round's pages are kept before the next is asked for.

        A restart begins each unfinished window anew, as cursors don't last, and skips the rows that are kept: their
        number is the window's frontier, before which it must not end. Without a limit all windows are read side by
        side; with one, in order, and none is asked for beyond it. Where it stopped and why stays on the run's facts, also
        of a run that fails.
        """
        spark, going = self.store.spark, {}
        while True:
            at = self.store.manifest()
            have = self.state(at).get("windows") or [{"start": start, "end": end, "rows": 0, "pages": 0, "total": 0, "done": False} for start, end in plan]
            if [(w["start"], w["end"]) for w in have] != [tuple(p) for p in plan]:
                raise ValueError("the windows are not those that the run began with, in their order")
            taken, windows = 0, []
            for k, (w, (start, end)) in enumerate(zip(have, plan, strict=True)):
                most = None if limit is None else limit - taken
                if not w["done"] and (most is None or (most > 0 and not windows)):
                    windows.append(crawl.Window(k, start, end, most, w["rows"], progress=going.get(k, crawl.Progress()), most_pages=pages_a_round))
                taken += w["rows"]
            if not windows:
                break
            raw = crawl.raw_pages(spark, windows, cap=str(cap), **options).withColumn("execution_id", F.lit(self.id))
            last: dict[int, dict] = {}

            def facts(folders: dict[str, str], have=have, at=at, last=last) -> dict:
                written = spark.read.parquet(f"{self.store.folder}/{folders['pages']}")
                for r in written.groupBy("window_id").agg(F.max_by("progress", "page_no").alias("p")).collect():  # a row for each window
                    last[r["window_id"]] = json.loads(r["p"])
                now = [{**w, "rows": max(w["rows"], last[k]["taken"]), "pages": max(w["pages"], last[k]["pages"]), "total": last[k]["total"], "cursor": last[k]["cursor"], "done": last[k]["done"]} if k in last else w for k, w in enumerate(have)]
                return self._fact(at, status="COLLECTING", windows=now, stopped=None, cap=cap, limit=limit, page_bound=sum(crawl.page_bound(limit, w["total"], int(options.get("rows", schema.PAGE_SIZE))) for w in now if w["pages"]))

            try:
                self.store.commit(facts=facts, more={"pages": raw}, base=at, tag=self.id)
            except Exception as error:
                why = next((x for x in ("page cap", "again and again", "without new rows", "before the", "more pages than the bound", "without a next cursor", "invalid page", "cursor expired", "gave up", "status") if x in str(error)), type(error).__name__)
                self.store.transact(lambda now, why=why: self.store.commit(facts=self._fact(now, stopped=f"failed: {why}"), base=now))
                raise
            going |= {k: crawl.Progress(**p) for k, p in last.items()}
            if not last:
                raise ValueError("the source gave no page")
        why = "limit" if limit is not None and taken >= limit else "end"
        self.store.transact(lambda now: self.store.commit(facts=self._fact(now, stopped=why, cap=cap, limit=limit), base=now))
        paged = self._read("pages", crawl.PAGES + ", execution_id string", self.store.manifest()).withColumn("page", F.from_json("page", schema.PAGE))
        self.evidence(crawl.page_log(paged))
        self.stage_items(crawl.items(paged), ["window_id", "page_no", "position"])

    def stage_items(self, items: DataFrame, order: list[str]) -> None:
        """Canonicalises collected records(item, ...) and stages them in the given total order. One bad record fails all."""
        works = settled(canonical.canonicalize(items))
        if bad := canonical.rejected(works).select("reason").first():
            raise ValueError(f"record rejected: {bad['reason']}")
        numbered = staging.dense_sequence(works, order, settle=settled).withColumns({"execution_id": F.lit(self.id), "collected_at": F.current_timestamp(), "source_error_key": F.lit(None).cast("bigint")})
        self.stage_rows(numbered, "COLLECTING")

    def stage_rows(self, rows: DataFrame, state: str) -> None:
        """Appends rows that aren't staged yet, gives them keys after all others, and freezes count and bound."""
        self.store.transact(lambda at: self._stage(rows, state, {}, at))

    def _stage(self, rows: DataFrame, state: str, tables: dict[str, DataFrame], at: dict, **more) -> None:
        have, top = self._read("staging", schema.STAGING, at), at["facts"].get("top_key", 0)
        new = staging.append_missing(rows.withColumn("execution_id", F.lit(self.id)), have, ["execution_id", "execution_sequence"])
        keyed, written = new.withColumn("staging_key", F.col("execution_sequence") + top), Observation()
        keyed = keyed.select([F.col(f.name).cast(f.dataType) for f in schema.STAGING]).observe(written, F.count(F.lit(1)).alias("n"), F.max("staging_key").alias("bound"))
        status = moved(moved("PENDING", state), "COLLECTED")

        def facts(_) -> dict:  # what the write itself has seen; only a run that had staged rows before looks at those
            seen = written.get
            n, bound = have.agg(F.count("*"), F.coalesce(F.max("staging_key"), F.lit(0))).first() if self.store.tagged("staging", at, self.id) else (0, 0)
            bound = max(bound, seen["bound"] or 0)
            return {**self._fact(at, status=status, expected=n + seen["n"], bound=bound, **more), "top_key": max(top, bound)}

        self.store.commit(tables, facts, more={"staging": keyed}, base=at, tag=self.id)

    def stage_replay(self, source_execution: str) -> None:
        """Copies the open errors of another execution, as of one version of the store; an error is counted in the same commit."""

        def work(at: dict) -> None:
            errors = self.store.read("errors", schema.ERRORS, at)
            rows = settled(replay.snapshot(errors, self.store.read("staging", schema.STAGING, at), source_execution, self.id, settled))
            if not rows.head(1):
                raise ValueError("the source execution has no open errors")
            selected, bound = rows.agg(F.count("*"), F.max("source_error_key")).first()
            self._stage(rows, "PREPARING", {"errors": replay.counted(errors, rows, source_execution)}, at, selected=selected, error_bound=bound)

        self.store.transact(work)

    def own(self, at: dict | None = None) -> DataFrame:
        at = at or self.store.manifest()
        return staging.in_range(self._read("staging", schema.STAGING, at), self.id, 0, self.state(at)["bound"])

    def synchronise(self) -> None:
        """Target, errors and chunk results in one commit. Of the target, buckets that the rows fall into are read, and those that change are written."""
        if self.state()["status"] != "COLLECTED":
            return
        moved("COLLECTED", "SYNCING")
        rows, columns = settled(self.own()), [c for c in schema.CANONICAL_COLUMNS if c != "doi"]
        cast = lambda df, shape: df.select([F.col(f.name).cast(f.dataType) for f in shape])

        def work(at: dict) -> None:
            looked = self.store.touched("target", rows, "doi", at)
            decided = settled(sync.decisions(rows, self.store.read("target", schema.TARGET, at, buckets=looked), self.chunk_size))
            written = self.store.touched("target", sync.winners(decided), "doi", at)
            target = self.store.read("target", schema.TARGET, at, buckets=written)
            new_target = sync.upserted(target, rows, decided, columns, F.current_timestamp())
            found, top = open_errors(self.store, sync.row_outcomes(decided, rows, self.chunk_size), at)
            self.store.commit(
                facts={**self._fact(at, status=moved("SYNCING", "VERIFYING")), "top_error": top},
                more={"errors": cast(found, schema.ERRORS), "chunks": cast(sync.chunk_results(decided, rows, self.chunk_size), schema.CHUNKS)},
                upserts={"target": (cast(new_target, schema.TARGET), "doi", written, looked)}, base=at, tag=self.id,
            )

        self.store.transact(work)

    def verify(self) -> dict:
        """The verdict; a clean incremental run moves the mark, a completed replay resolves its sources."""
        return self.store.transact(self._verify)

    def _verify(self, at: dict) -> dict:
        facts = self.state(at)
        if facts.get("verdict"):
            return facts["verdict"]
        if facts.get("status") != "VERIFYING" or facts.get("expected") is None or facts.get("bound") is None:
            raise ValueError(f"a run that is {facts.get('status')} can't be verified")
        spark, own = self.store.spark, self.own(at)
        replayed = self.request.mode == "REPLAY_ERRORS"
        expected = spark.createDataFrame([(self.id, facts["expected"])], "execution_id string, expected_count bigint")
        target = self.store.read("target", schema.TARGET, at, buckets=self.store.touched("target", own, "doi", at))
        row = verify.verdicts(own, self._read("chunks", schema.CHUNKS, at), self._read("errors", schema.ERRORS, at), target, expected, replayed, settled).first()
        verdict, tables, extra = row.asDict(), {}, {}
        if replayed and row["status"] == "COMPLETED":
            tables["errors"] = settled(replay.resolved(self.store.read("errors", schema.ERRORS, at), own, True, F.current_timestamp(), self.request.identity["source_execution"]))
        if self.request.mode == "INCREMENTAL":
            source, until = self.request.identity.get("source", "default"), facts["until"]
            mark = at["facts"].get(f"mark:{source}")
            lit = lambda x: F.lit(x).cast("timestamp")
            if spark.range(1).select(may_advance(F.lit("INCREMENTAL"), F.lit(row["status"] != "FAILED"), F.lit(row["conflicts"]), lit(mark), lit(until))).first()[0]:
                extra[f"mark:{source}"] = until
        self.store.commit(tables, {**self._fact(at, status=moved("VERIFYING", row["status"]), verdict=verdict, finished=datetime.now(UTC).isoformat()), **extra}, base=at)
        return verdict

    def finish(self) -> int:
        self.step("sync", self.synchronise)
        return EXIT[self.step("verify", self.verify)["status"]]


def run(store: Store, request: Request, collected: tuple[DataFrame, list[str]] | None = None, rows: DataFrame | None = None, chunk_size: int = schema.CHUNK_SIZE, pages: DataFrame | None = None, plan: dict | None = None) -> int:
    """A whole run; the exit code. collected: records and their order; rows: staged rows made otherwise (BENCHMARK); pages: a log of them; plan: what collect() takes."""
    job = Run(store, request, chunk_size)
    if job.begin() == "ALREADY_COMPLETED":
        return EXIT["ALREADY_COMPLETED"]
    if job.state()["status"] in ("PENDING", "COLLECTING"):
        if request.mode == "REPLAY_ERRORS":
            job.step("collect", job.stage_replay, request.identity["source_execution"])
        elif rows is not None:
            job.step("collect", job.stage_rows, rows, "COLLECTING")
        elif plan is not None:
            job.step("collect", job.collect, **plan)
        else:
            if pages is not None:
                job.evidence(pages)
            job.step("collect", job.stage_items, *collected)
    return job.finish()
