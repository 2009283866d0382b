"""Jobs that feed each other, declared as a graph: topics with a record type as edges, streaming queries as nodes.

The declaration is checked as a whole before anything starts: every topic that is read is written by a job or comes
from outside, each end of a topic means the same record, and no job feeds itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Edge:
    """A topic and what its messages hold. ``outside``: written by others as well."""

    name: str
    record: T.StructType
    outside: bool = False


@dataclass(frozen=True)
class Node:
    """A job: the topics it reads and writes, with the record it takes them for, and how it starts."""

    name: str
    start: Callable[[], StreamingQuery]
    reads: Mapping[str, T.StructType] = field(default_factory=dict)
    writes: Mapping[str, T.StructType] = field(default_factory=dict)


def _fields(record: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in record.fields]


class Graph:
    """Checked when made; ``order`` names the jobs with writers before their readers."""

    def __init__(self, edges: Iterable[Edge], nodes: Iterable[Node]):
        self.edges, self.nodes = list(edges), list(nodes)
        self.order = self._checked()

    def _checked(self) -> list[str]:
        known, faults = {e.name: e for e in self.edges}, []
        for kind, names in (("topic", [e.name for e in self.edges]), ("job", [n.name for n in self.nodes])):
            faults += [f"{kind} {x} is declared twice" for x in sorted({x for x in names if names.count(x) > 1})]
        writers = {e: [n.name for n in self.nodes if e in n.writes] for e in known}
        for node in self.nodes:
            for verb, ends in (("reads", node.reads), ("writes", node.writes)):
                for name, record in ends.items():
                    if name not in known:
                        faults.append(f"{node.name} {verb} {name}, which is not declared")
                    elif not set(_fields(record)) <= set(_fields(known[name].record)):
                        faults.append(f"{node.name} {verb} {name} as another record")
        used = {e for n in self.nodes for e in (*n.reads, *n.writes)}
        for name, edge in known.items():
            if not writers[name] and not edge.outside:
                faults.append(f"nothing writes {name}")
            if name not in used:
                faults.append(f"no job uses {name}")
        if faults:
            raise ValueError("; ".join(faults))
        before = {n.name: {w for e in n.reads for w in writers[e]} for n in self.nodes}
        try:
            return list(TopologicalSorter(before).static_order())
        except CycleError as cycle:
            raise ValueError(f"jobs feed themselves: {' -> '.join(cycle.args[1])}") from None

    def node(self, name: str) -> Node:
        return next(n for n in self.nodes if n.name == name)

    def start(self) -> dict[str, StreamingQuery]:
        """Start all jobs, readers before their writers, so that a reader of new messages misses none. All or none run."""
        queries: dict[str, StreamingQuery] = {}
        try:
            for name in reversed(self.order):
                queries[name] = self.node(name).start()
        except BaseException:
            stop(queries)
            raise
        return queries

    def run_in_turn(self) -> None:
        """For jobs that end when they have read what is there: each runs after those that feed it."""
        for name in self.order:
            self.node(name).start().awaitTermination()


def stop(queries: Mapping[str, StreamingQuery]) -> None:
    for query in queries.values():
        query.stop()


def run_until_stopped(queries: Mapping[str, StreamingQuery], poll: float = 1.0) -> None:
    """Block while all jobs run. When one ends or fails, or on an interrupt, the others stop too; a failure is raised."""
    try:
        while all(q.isActive for q in queries.values()):
            time.sleep(poll)
    except KeyboardInterrupt:
        pass
    finally:
        stop(queries)
    for query in queries.values():
        if query.exception() is not None:
            raise query.exception()
