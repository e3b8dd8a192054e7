"""Times the headline queries; prints one JSON line.

A query that takes less than SHORT seconds is run three times, and the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ferryline import suite
from ferryline.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS, SHORT = 3, 4.0

HEADLINE = """
    q01_csv_feed q02_json_array_file q04_json_message q05_json_array_message q06_envelope
    q07_xml_payload q08_changelog_apply q12_cast q14_transform_chain q15_explode_children
    q17_time_range q20_new_keys_only q21_parent_children q22_lookup_chain q24_batch_count
    q25_key_partition q27_zone_epoch q28_date_time_epoch q29_time_of_day q31_upsert
    q31c_latest_per_key q32_delete_insert q33_replace_batch q33b_batch_loaded_twice
    q34_fanout_counts q36_table_copy q37_json_encode q38_json_export q40_stream_land
    q41_replay_safe_append f01_aa_traj f32_tgt f36_t_shirt_hrv f44_eeg_emg f46_joint_posture
    f49_sorties f53_flight_plan_file f56_equipment_info
""".split()


def timed(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "bench")
    known = suite.queries()
    # One untimed query so that starting the engine is not charged to the first one.
    known["q24_batch_count"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = [timed(known[name], spark)]
        while taken[0] < SHORT and len(taken) < REPEATS:
            taken.append(timed(known[name], spark))
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
