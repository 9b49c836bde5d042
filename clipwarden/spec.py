"""Schemas, the target profile and thresholds shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: target clip profile -------------------------------------
TARGET_WIDTH = 1280
TARGET_HEIGHT = 704
TARGET_FPS = 24.0
TARGET_FRAMES = 121
OVERLAP_WINDOW_SEC = 4.5
OVERLAP_REJECT_THRESHOLD = 100  # reported beside the verdict, never decides it
SPEC_DURATION_SEC = 5.041667

# --- Fixed values: clip record columns, in file order ----------------------
CLIP_SCHEMA = T.StructType(
    [
        T.StructField("clip_id", T.StringType()),
        T.StructField("clip_uri", T.StringType()),
        T.StructField("clip_sha256", T.StringType()),
        T.StructField("first_frame_uri", T.StringType()),
        T.StructField("first_frame_sha256", T.StringType()),
        T.StructField("source_video_id", T.StringType()),
        T.StructField("clip_start_sec", T.DoubleType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("fps", T.DoubleType()),
        T.StructField("num_frames", T.LongType()),
        T.StructField("source_video_url", T.StringType()),
        T.StructField("caption", T.StringType()),
    ]
)
CLIP_COLUMNS = CLIP_SCHEMA.fieldNames()

# --- Fixed values: columns that must be numeric, with their types ----------
NUMERIC_COLUMNS = {
    "clip_start_sec": "double",
    "duration_sec": "double",
    "width": "bigint",
    "height": "bigint",
    "fps": "double",
    "num_frames": "bigint",
    "motion_mean": "double",
    "motion_median": "double",
    "motion_max": "double",
    "thres": "double",
    "moving_frames": "bigint",
    "total_pairs": "bigint",
    "moving_ratio": "double",
    "count_num": "bigint",
    "dynamic": "double",
    "aesthetic_quality": "double",
}

# --- Fixed values: fields compared between two dataset versions ------------
COMPARE_FIELDS = [
    "clip_sha256",
    "first_frame_sha256",
    "source_video_id",
    "source_video_url",
    "clip_start_sec",
    "duration_sec",
    "width",
    "height",
    "fps",
    "num_frames",
    "caption",
]

# --- Fixed values: quality report columns, in file order -------------------
QUALITY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("source_width", T.IntegerType()),
        T.StructField("source_height", T.IntegerType()),
        T.StructField("source_frames", T.IntegerType()),
        T.StructField("source_fps", T.DoubleType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("duplicate_frame_ratio", T.DoubleType()),
        T.StructField("temporal_diff_mean", T.DoubleType()),
        T.StructField("temporal_diff_std", T.DoubleType()),
        T.StructField("motion_p95", T.DoubleType()),
        T.StructField("flicker_luma_std", T.DoubleType()),
        T.StructField("sharpness_grad_mean", T.DoubleType()),
        T.StructField("entropy_mean", T.DoubleType()),
        T.StructField("black_pixel_ratio", T.DoubleType()),
        T.StructField("white_pixel_ratio", T.DoubleType()),
        T.StructField("aspect_error", T.DoubleType()),
        T.StructField("frame_error", T.IntegerType()),
        T.StructField("fps_error", T.DoubleType()),
        T.StructField("conformance_score", T.DoubleType()),
        T.StructField("timelapse_score", T.DoubleType()),
        T.StructField("high_motion_ratio", T.DoubleType()),
        T.StructField("scene_cut_count", T.IntegerType()),
        T.StructField("grade", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
QUALITY_COLUMNS = QUALITY_SCHEMA.fieldNames()

ISSUE_STRUCT = (
    "struct<severity:string,code:string,message:string,fix:string,"
    "line:bigint,sample_id:string,video:string,value:string>"
)
ISSUE_COLUMNS = ["severity", "code", "message", "fix", "line", "sample_id", "video", "value"]

SOURCE_INFO_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("fps", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

SEARCH_SCHEMA = (
    "videos array<struct<id:bigint,url:string,video_files:array<struct<"
    "height:int,width:int,fps:double,link:string,file_type:string>>>>"
)

# --- Fixed values: source screening keywords -------------------------------
REJECT_KEYWORDS = [
    "timelapse", "time-lapse", "time lapse", "hyperlapse",
    "relaxation", "meditation", "ambient", "calming", "sleep",
    "slideshow", "wallpaper", "screensaver", "asmr",
    "nature sounds", "4k scenery", "scenery", "landscape only",
    "meditative", "soothing", "zen", "fireplace", "rain sounds",
    "virtual walk", "static", "loop", "10 hours", "1 hour",
    "compilation", "best of", "top 10", "mix",
]
KEEP_KEYWORDS = [
    "documentary", "wildlife", "animals", "nature documentary",
    "gimbal", "stabilized", "follow shot", "tracking shot",
    "walking", "hiking", "running", "cycling", "skiing",
    "real time", "realtime", "live",
    "close up", "slow motion",
]

# --- Fixed values: accepted video file extensions --------------------------
VIDEO_EXTENSIONS = ["mp4", "mov", "mkv", "webm", "avi"]


@dataclass(frozen=True)
class TargetSpec:
    """The clip profile that conformance and lint rules measure against."""

    width: int = TARGET_WIDTH
    height: int = TARGET_HEIGHT
    fps: float = TARGET_FPS
    frames: int = TARGET_FRAMES

    @property
    def duration(self) -> float:
        return self.frames / self.fps


@dataclass(frozen=True)
class GradeThresholds:
    """Limits above which a clip fails."""

    dup_ratio: float = 0.05
    timelapse_score: float = 0.50
    clipping_ratio: float = 0.15
    min_conformance: float = 0.50
    scene_cut_max: int = 0


@dataclass(frozen=True)
class SampleThresholds:
    """Limits above which a sampled source is rejected."""

    dup_ratio: float = 0.05
    static_ratio: float = 0.50
    timelapse_score: float = 0.50


@dataclass(frozen=True)
class LintConfig:
    """Settings of the manifest linter."""

    target: TargetSpec = TargetSpec()
    fps_tolerance: float = 0.75
    allow_resize: bool = True
    train_batch_size: int = 1
    num_workers: int = 0
    pin_memory: bool = False
    #: Decode failures after which issues are marked `after_stop`; None marks nothing.
    max_decode_failures: int | None = None
