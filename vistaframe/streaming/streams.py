"""Order-dependent passes as Structured Streaming jobs; each agrees with its batch operator on a replay."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vistaframe.operators.dataset import frame_qc
from vistaframe.operators.tracks import Matcher
from vistaframe.sources.tables import ship
from vistaframe.sources.versions import upsert


def with_millis(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """rows with ts as a number of milliseconds, millis: so late rows reach the operator, which tells them by the watermark, instead of vanishing before it."""
    return rows.withColumn("millis", F.unix_millis(ts)).drop(ts)


class FrameRelease(StatefulProcessor):
    """Frames wait until the watermark has passed them, and leave in their order. State: waiting frames as a list; saved frames and rejects as a value."""

    def __init__(self, most: int) -> None:
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ms long, ordinal long, reason string")
        self.counts = handle.getValueState("counts", "saved long, blur long, features long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            if batch.empty:  # a key that comes up for its timers only
                continue
            late = batch["millis"] < mark
            own = batch[~late]
            if len(own):
                self.waiting.appendList([(int(m), int(o), None if pd.isna(r) else r) for m, o, r in zip(own["millis"], own["ordinal"], own["reason"], strict=True)])
                for ms in own["millis"].unique():
                    self.handle.registerTimer(int(ms) + 1)
            if late.any():
                yield self.out(key, [(int(o), None, None, None, True) for o in batch[late]["ordinal"]])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        held = sorted((tuple(w) for w in self.waiting.get()), key=lambda w: w[:2])
        ready = [w for w in held if w[0] < mark]
        if not ready:
            return
        saved, blur, few = self.counts.get() if self.counts.exists() else (0, 0, 0)
        out = []
        for _, ordinal, reason in ready:
            if saved >= self.most:
                break
            saved, blur, few = saved + (reason is None), blur + (reason == "blur"), few + (reason == "features")
            if reason is None:
                out.append((ordinal, saved, blur, few, False))
        self.counts.update((saved, blur, few))
        left = held[len(ready) :]
        self.waiting.clear()
        if left:
            self.waiting.put(left)
        yield self.out(key, out)

    def out(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=["ordinal", "saved", "rejected_blur", "rejected_features", "late"], dtype=object)
        found.insert(0, "scene_id", key[0])
        return found.astype({c: "Int64" for c in ("ordinal", "saved", "rejected_blur", "rejected_features")} | {"late": bool})

    def close(self) -> None:
        pass


def stream_frame_qc(frames: DataFrame, min_sharpness: float, min_features: int, most: int) -> DataFrame:
    """A stream of frames (scene_id, ordinal, sharpness, features, ts with a watermark) to those saved: (scene_id, ordinal, saved, rejected_blur,
    rejected_features, late), numbered by scene up to `most`, with how many frames before them were rejected for what.

    A frame is judged when the watermark has passed its ts; frames go in order of ts and ordinal, whatever micro-batches they
    came in. After the last saved frame nothing is counted. A frame behind the watermark is late: a row of nulls with late true.
    """
    ship(frames.sparkSession)
    judged = with_millis(frame_qc(frames, min_sharpness, min_features).select("scene_id", "ordinal", "reason", "ts"))
    return judged.groupBy("scene_id").transformWithStateInPandas(FrameRelease(most), "scene_id string, ordinal long, saved long, rejected_blur long, rejected_features long, late boolean", "Append", "EventTime")


class TrackRelease(StatefulProcessor):
    """Detections wait until their frame is whole. State: the class's counter as a value; active tracks and waiting detections as lists."""

    BOX = ("x0", "y0", "x1", "y1")

    def init(self, handle: StatefulProcessorHandle) -> None:
        box = ", ".join(f"{c} double" for c in self.BOX)
        self.handle = handle
        self.number = handle.getValueState("number", "number long")
        self.active = handle.getListState("active", f"number long, rank long, {box}")
        self.waiting = handle.getListState("waiting", f"rank long, ordinal long, ms long, confidence double, {box}")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            if batch.empty:  # a key that comes up for its timers only
                continue
            late = batch["millis"] < mark
            own = batch[~late]
            if len(own):
                self.waiting.appendList([(int(r.rank), int(r.ordinal), int(r.millis), float(r.confidence), *(float(getattr(r, c)) for c in self.BOX)) for r in own.itertuples(index=False)])
                for ms in own["millis"].unique():
                    self.handle.registerTimer(int(ms) + 1)
            if late.any():
                yield self.out(key, [(int(o), None, True) for o in batch[late]["ordinal"]])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        held = sorted(tuple(w) for w in self.waiting.get())
        # A frame is open until all that it has so far lies before the watermark.
        open_from = min((w[0] for w in held if w[2] >= mark), default=None)
        ready = [w for w in held if open_from is None or w[0] < open_from]
        if not ready:
            return
        matcher = Matcher(self.number.get()[0] if self.number.exists() else 0, [list(t) for t in self.active.get()])
        out = []
        for rank in sorted({w[0] for w in ready}):
            own = [w for w in ready if w[0] == rank]
            out += [(w[1], n, False) for w, n in zip(own, matcher.frame(rank, [(w[3], w[4:]) for w in own]), strict=True)]
        self.number.update((matcher.number,))
        for state, rows in ((self.active, [tuple(t) for t in matcher.active]), (self.waiting, held[len(ready) :])):
            state.clear()
            if rows:
                state.put(rows)
        yield self.out(key, out)

    def out(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=["ordinal", "track", "late"], dtype=object)
        found.insert(0, "scene_id", key[0])
        found.insert(1, "class_name", key[1])
        return found.astype({"ordinal": "Int64", "track": "Int64", "late": bool})

    def close(self) -> None:
        pass


def stream_tracks(detections: DataFrame) -> DataFrame:
    """A stream of detections (scene_id, class_name, ordinal, rank, ts, confidence, x0..y1) to (scene_id, class_name, ordinal, track, late), by the rule of associate_detections().

    rank numbers the frames that have detections, and ts must carry a watermark: a frame is matched when the watermark has
    passed its time, so all its detections are there. Detections behind the watermark are late: they have no track and late is
    true, for a side table (see split_late()). A class's state is its active tracks and open frames.
    """
    ship(detections.sparkSession)
    rows = with_millis(detections).select("scene_id", "class_name", "ordinal", "rank", "millis", "confidence", *TrackRelease.BOX)
    return rows.groupBy("scene_id", "class_name").transformWithStateInPandas(TrackRelease(), "scene_id string, class_name string, ordinal long, track long, late boolean", "Append", "EventTime")


def split_late(stream: DataFrame, path: str, late_path: str) -> DataStreamWriter:
    """A writer of a stream with late: rows in time to the Parquet table at path, late ones to that at late_path. A batch that is repeated replaces its own part."""

    def put(rows: DataFrame, number: int) -> None:
        for at, own in ((path, rows.where("NOT late")), (late_path, rows.where("late"))):
            own.drop("late").write.mode("overwrite").parquet(f"{at}/batch={number}")

    return stream.writeStream.foreachBatch(put)


def stream_stage_state(events: DataFrame) -> DataFrame:
    """A stream of (scene_id, stage, status, at) to each stage's last status; for update or complete mode."""
    return events.groupBy("scene_id", "stage").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"))


def stream_trials(trials: DataFrame) -> DataFrame:
    """A stream of trials to the best of each kind so far; of equal scores the first inserted. For update or complete mode."""
    scored = trials.where((F.col("status") == "scored") & F.col("quality_score").isNotNull())
    best = F.max_by(F.struct("ordinal", "quality_score"), F.struct("quality_score", -F.col("ordinal")))
    return scored.groupBy("kind").agg(best.alias("best")).select("kind", "best.*")


def store_trials(trials: DataFrame, path: str, key: list[str], order: str) -> DataStreamWriter:
    """A writer of a stream of trials to the versioned table at path: a trial replaces the one of its key, the last by `order` in a batch.

    A version carries its batch's number, so a batch that is repeated after a failure changes nothing.
    """

    def put(rows: DataFrame, number: int) -> None:
        last = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), F.col(order)).alias("_row")).select("_row.*")
        upsert(last, path, key, number)

    return trials.writeStream.foreachBatch(put)
