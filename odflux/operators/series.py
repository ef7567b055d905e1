"""One zone's slots in time order, filled and described inside Arrow batches.

Spark joins, shuffles and sorts the observed rows, which are few beside the slots of
the calendar; a task then walks its zones in order and writes out every slot with its
lags, trailing statistics and label at once. The filled grid is thus never shuffled,
sorted or buffered: a task holds the slots of one zone, or of several that together
have no more than ``ROWS_AT_ONCE``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

ROWS_AT_ONCE = 65_536


def slot_writer(step: int, width: int, fields: list[tuple[str, str]], zeroed: list[str], carried: list[str], held: list[str],
                beside: list[str], dated: dict[str, float], lags: list[tuple[str, int, str]], spans: list[int], horizon: int,
                at_once: int = ROWS_AT_ONCE) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow`` over rows sorted by zone and time; ``fields`` are the (name, type) that it returns.

    A row with ``_emit`` of 1 or more stands for that many slots from ``_first`` on. Of its
    values ``zeroed`` hold in its own slot only, ``carried`` from there on, ``held`` in all of
    them. Rows with an ``_emit`` of 0 bring values ``beside`` one slot (``_side`` 1), or
    ``dated`` ones that hold from then on (``_side`` 2), with what holds before the first.
    """
    # All that runs in the workers is nested, so that it travels by value and no package is needed there.
    def run(batches):
        import numpy as np
        import pyarrow as pa

        kinds = {"int": (pa.int32(), np.int32), "bigint": (pa.int64(), np.int64), "double": (pa.float64(), np.float64)}

        def back(values, n, leads, fill):
            """The value ``n`` slots before, ``fill`` where the zone has no such slot."""
            out = np.empty_like(values)
            out[n:] = values[:-n]
            out[leads(n)] = fill
            return out

        def trailing(trips, place, leads, out):
            running = {"sum": np.cumsum(trips), "squares": np.cumsum(trips * trips)}
            began = np.arange(len(trips)) - place
            # Totals of the zone alone: what the zones before it in the batch added up to comes off.
            running = {k: v - (v[began] - (trips[began] if k == "sum" else trips[began] ** 2)) for k, v in running.items()}
            blocks, length = {1: (trips, trips)}, 1
            while 2 * length <= max(spans):
                top, low = blocks[length]
                blocks[2 * length] = (np.maximum(top, back(top, length, leads, -np.inf)), np.minimum(low, back(low, length, leads, np.inf)))
                length *= 2
            for span in spans:
                n = np.minimum(place, span).astype(np.float64)
                total, squares = (back(v, 1, leads, 0.0) - back(v, span + 1, leads, 0.0) for v in (running["sum"], running["squares"]))
                block = max(b for b in blocks if b <= span)
                top = np.maximum(*[back(blocks[block][0], k, leads, -np.inf) for k in (1, 1 + span - block)])
                low = np.minimum(*[back(blocks[block][1], k, leads, np.inf) for k in (1, 1 + span - block)])
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean = np.where(n > 0, total / n, 0.0)
                    spread = np.sqrt(np.maximum(n * squares - total * total, 0.0) / (n * (n - 1.0)))
                out[f"trip_count_mean_{span}"] = mean
                out[f"trip_count_stddev_{span}"] = np.where(n > 1, spread, 0.0)
                out[f"trip_count_max_{span}"] = np.where(n > 0, top, 0.0)
                out[f"trip_count_min_{span}"] = np.where(n > 0, low, 0.0)
                out[f"trip_count_trend_{span}"] = trips - mean

        def written(rows):
            """All slots of the zones of ``rows``, a dict of arrays."""
            own = rows["_emit"] > 0
            emit = rows["_emit"][own]
            total = int(emit.sum())
            if not total:
                return None
            row = {k: v[own] for k, v in rows.items()}
            src = np.repeat(np.arange(len(emit)), emit)
            step_in = np.arange(total) - (np.cumsum(emit) - emit)[src]
            zone, at = row["location_id"][src], row["_at"][src]
            start = row["_first"][src] + step_in * step
            fresh = np.flatnonzero(np.concatenate([[True], zone[1:] != zone[:-1]]))
            sizes = np.diff(np.append(fresh, total))
            place = np.arange(total) - np.repeat(fresh, sizes)
            on = row["_on"][src]
            # Few slots are observed, so what holds in those only is put in there.
            seen = np.flatnonzero(on & (start == at))
            before = np.flatnonzero(~on | (start < at))
            whose = src[seen]

            def leads(n):
                """Places of the first ``n`` slots of each zone."""
                first = np.minimum(sizes, n)
                return np.arange(int(first.sum())) + np.repeat(fresh - (np.cumsum(first) - first), first)

            def put(values, places, there):
                values[places] = there
                return values

            out = {"location_id": zone, "window_start": start, "window_end": put(start + width, seen, row["_end"][whose])}
            out.update({c: put(np.zeros(total), seen, row[c][whose]) for c in zeroed})
            out.update({c: put(np.repeat(row[c], emit).astype(np.float64, copy=False), before, 0.0) for c in carried})
            out.update({c: np.repeat(row[c], emit) for c in held})
            if spans:
                trailing(out["trip_count"], place, leads, out)
            for column, n, name in lags:
                out[name] = back(out[column], n, leads, 0.0)
            ids = zone[fresh]

            def of_zone(side):
                """Rows of the side whose zone has slots here, and the number of that zone."""
                number = np.minimum(np.searchsorted(ids, rows["location_id"][side]), len(ids) - 1)
                known = ids[number] == rows["location_id"][side]
                return side[known], number[known]

            if beside:
                side, number = of_zone(np.flatnonzero(rows["_side"] == 1))
                off = rows["_at"][side] - start[fresh[number]]
                nth = off // step
                fits = (off % step == 0) & (nth >= 0) & (nth < sizes[number])
                for c in beside:
                    out[c] = np.zeros(total)
                    out[c][(fresh[number] + nth)[fits]] = rows[c][side][fits]
            if dated:
                side, number = of_zone(np.flatnonzero(rows["_side"] == 2))
                least = int(rows["_at"].min())
                least = min(least, int(start.min()))
                range_of = max(int(rows["_at"].max()), int(start.max())) - least + 1
                if len(side):
                    number_of = np.repeat(np.arange(len(ids)), sizes)
                    last = np.searchsorted(number * range_of + (rows["_at"][side] - least), number_of * range_of + (start - least), side="right") - 1
                    holds = (last >= 0) & (number[last] == number_of)
                for c, first in dated.items():
                    out[c] = np.where(holds, rows[c][side][last], first) if len(side) else np.full(total, first)
            kept = None
            if horizon:
                length = np.repeat(sizes, sizes)
                kept = place + horizon < length
                ahead = lambda values: np.concatenate([values[horizon:], values[:horizon]])
                out["target_trip_count"], out["target_window_start"] = ahead(out["trip_count"]), ahead(start)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(out[name].astype(kinds[kind][1], copy=False), kinds[kind][0]) for name, kind in fields], [n for n, _ in fields])
            return batch if kept is None else batch.filter(pa.array(kept))

        def zones_of(table, whole):
            """Batches of the zones of the table that are complete, and how many rows they are."""
            zone = table.column("location_id").to_numpy()
            end = len(zone) if whole else int(np.searchsorted(zone, zone[-1]))
            rows = {n: table.column(n).to_numpy() for n in table.column_names}
            begins = np.flatnonzero(np.concatenate([[True], zone[1:end] != zone[:end - 1]])) if end else np.zeros(0, np.int64)
            if not len(begins):
                return [], 0
            slots = np.cumsum(np.add.reduceat(rows["_emit"][:end], begins))
            cut, cuts, done = 0, [], 0
            while cut < len(begins):
                # As many whole zones as fit, one at least.
                cut = max(int(np.searchsorted(slots, done + at_once, side="right")), cut + 1)
                done = slots[cut - 1]
                cuts.append(int(begins[cut]) if cut < len(begins) else end)
            return ({n: v[a:b] for n, v in rows.items()} for a, b in zip([0, *cuts[:-1]], cuts)), end

        held_back = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held_back.append(batch)
            if held_back[0].column("location_id")[0] == batch.column("location_id")[batch.num_rows - 1]:
                continue  # still the zone that the first of them began with
            table = pa.Table.from_batches(held_back)
            chunks, end = zones_of(table, False)
            yield from filter(None, map(written, chunks))
            held_back = table.slice(end).to_batches()
        if held_back:
            chunks, _ = zones_of(pa.Table.from_batches(held_back), True)
            yield from filter(None, map(written, chunks))

    return run
