"""Ranked-snapshot tracking on Spark."""

__version__ = "0.1.0"

from .functions.times import check_time_window  # noqa: E402
from .operators.classify import (  # noqa: E402
    classify_reconcile,
    classify_stories,
    fetch_candidates,
    status_transitions,
)
from .operators.collect import (  # noqa: E402
    assemble_run,
    fetch_outcomes,
    record_run_story,
    run_errors,
    run_story_errors,
)
from .operators.export import export_changed  # noqa: E402
from .operators.legacy import (  # noqa: E402
    classify_rankbump,
    filter_rankbump,
    stats_run_story_legacy,
)
from .operators.maintenance import (  # noqa: E402
    export_tables,
    mark_stale_unknown,
    merge_conflicts,
    merge_instances,
    migrate_v015,
    rewrite_stale_unknown,
)
from .operators.ranks import (  # noqa: E402
    data_cube,
    max_item_id,
    rebuild_run_arrays,
    stories_ranks,
    story_timeline,
    top_n_from_json,
)
from .operators.report_state import coverage_report, story_report, update_report  # noqa: E402
from .operators.reports import (  # noqa: E402
    diagnose_errors,
    missing_runs_at,
    retry_profile,
    run_ruptures,
    stats_run,
    stats_run_story,
    stats_run_story_coverage,
)
from .operators.status import (  # noqa: E402
    last_recorded_run,
    last_recorded_runs,
    merge_states,
    stories_status,
    story_state,
)
from .plans.cycle import run_cycle  # noqa: E402
from .plans.replay import replay_history  # noqa: E402
from .plans.snapshots import classify_as_of, extend_snapshots, thin_snapshots  # noqa: E402
from .ruleset import Ruleset, load_ruleset  # noqa: E402
from .session import get_spark  # noqa: E402
from .sources.histories import append_histories, story_history  # noqa: E402
from .sources.responses import extract_item_fields, parse_items, parse_rankings  # noqa: E402
from .streaming.compaction import compact  # noqa: E402
from .streaming.live import stream_cycle  # noqa: E402
from .streaming.stories import stream_stories  # noqa: E402

__all__ = [
    "Ruleset",
    "append_histories",
    "assemble_run",
    "check_time_window",
    "classify_as_of",
    "classify_rankbump",
    "classify_reconcile",
    "classify_stories",
    "compact",
    "coverage_report",
    "data_cube",
    "diagnose_errors",
    "export_changed",
    "export_tables",
    "extend_snapshots",
    "extract_item_fields",
    "fetch_candidates",
    "fetch_outcomes",
    "filter_rankbump",
    "get_spark",
    "last_recorded_run",
    "last_recorded_runs",
    "load_ruleset",
    "mark_stale_unknown",
    "max_item_id",
    "merge_conflicts",
    "merge_instances",
    "merge_states",
    "migrate_v015",
    "missing_runs_at",
    "parse_items",
    "parse_rankings",
    "rebuild_run_arrays",
    "record_run_story",
    "replay_history",
    "retry_profile",
    "rewrite_stale_unknown",
    "run_cycle",
    "run_errors",
    "run_ruptures",
    "run_story_errors",
    "stats_run",
    "stats_run_story",
    "stats_run_story_coverage",
    "stats_run_story_legacy",
    "status_transitions",
    "stories_ranks",
    "stories_status",
    "story_history",
    "story_report",
    "story_state",
    "story_timeline",
    "stream_cycle",
    "stream_stories",
    "thin_snapshots",
    "top_n_from_json",
    "update_report",
]
