"""Shortest paths from some sources of a graph, walked level by level inside Arrow tasks.

Spark deals the sources out to tasks, sends each task the links and adds up what the
tasks return. A task holds the links and a few numbers a node, whatever the number of
its sources, which it takes one after another; nothing is kept a pair of nodes.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa


def path_sums(weighted: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Function for a cogroup of sources (``source``) and links (``src``, ``dst``, ``w``): (id, total, squares) of its nodes.

    ``total`` adds up, over the sources of the group, a node's share of all shortest paths from the source to
    other nodes, ends excluded, and ``squares`` the squares of that.
    """
    # All that runs in the workers is nested, so that it travels by value and no package is needed there.
    def run(sources, links):
        import numpy as np
        import pyarrow as pa

        count = links.num_rows
        # Nodes as numbers from 0 on, whatever the type of their ids.
        ids = pa.concat_arrays([c for name in ("src", "dst") for c in links.column(name).chunks]
                               + sources.column("source").cast(links.schema.field("src").type).chunks).dictionary_encode()
        number, names = ids.indices.to_numpy(), ids.dictionary
        n = len(names)
        order = np.argsort(number[:count], kind="stable")
        dst, cost = number[count:2 * count][order], links.column("w").to_numpy()[order]
        degree = np.bincount(number[:count], minlength=n)
        src = np.repeat(np.arange(n, dtype=np.int32), degree)
        begins = np.cumsum(degree) - degree

        def out_of(front, degree, begins):
            """Places of the links out of the nodes of ``front``."""
            d = degree[front]
            return np.arange(int(d.sum())) + np.repeat(begins[front] - (np.cumsum(d) - d), d)

        def by_hops(source):
            """Links on shortest paths, level by level, and the number of shortest paths to each node."""
            seen, paths = np.zeros(n, dtype=bool), np.zeros(n)
            front, seen[source], paths[source] = np.array([source]), True, 1.0
            levels = []
            while len(front):
                at = out_of(front, degree, begins)
                at = at[~seen[dst[at]]]
                came = np.bincount(dst[at], weights=paths[src[at]], minlength=n)
                front = np.flatnonzero(came)
                seen[front], paths[front] = True, came[front]
                levels.append((src[at], dst[at]))
            return levels, paths

        def by_cost(source):
            """As ``by_hops``; a node's level is the longest of its shortest paths, so all that lead to it come before."""
            least = np.full(n, np.inf)
            least[source], front = 0.0, np.array([source])
            while len(front):
                at = out_of(front, degree, begins)
                to, offer = dst[at], least[src[at]] + cost[at]
                better = offer < least[to]
                to = to[better]
                np.minimum.at(least, to, offer[better])
                front = np.zeros(n, dtype=bool)
                front[to] = True
                front = np.flatnonzero(front)
            tight = np.flatnonzero(np.isfinite(least[src]) & (least[src] + cost == least[dst]))
            frm, to = src[tight], dst[tight]
            own = np.bincount(frm, minlength=n)
            starts, waits, paths = np.cumsum(own) - own, np.bincount(to, minlength=n), np.zeros(n)
            front, paths[source], levels, reached = np.array([source]), 1.0, [], 1
            while len(front):
                at = out_of(front, own, starts)
                paths += np.bincount(to[at], weights=paths[frm[at]], minlength=n)
                waits -= np.bincount(to[at], minlength=n)
                levels.append((frm[at], to[at]))
                here = np.unique(to[at])
                front = here[waits[here] == 0]
                reached += len(front)
            if reached < np.isfinite(least).sum():
                raise ValueError("some path costs are too small to count beside the others")
            return levels, paths

        total, squares = np.zeros(n), np.zeros(n)
        for source in number[2 * count:]:
            levels, paths = (by_cost if weighted else by_hops)(source)
            credit = np.zeros(n)
            # Backwards: each node hands its share to the nodes right before it on shortest paths.
            for frm, to in reversed(levels):
                credit += np.bincount(frm, weights=(1.0 + credit[to]) / paths[to], minlength=n) * paths
            credit[source] = 0.0
            total += credit
            squares += credit * credit
        own = np.flatnonzero(total)
        return pa.table({"id": names.take(pa.array(own)), "total": total[own], "squares": squares[own]})

    return run
