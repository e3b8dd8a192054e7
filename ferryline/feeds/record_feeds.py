"""Feeds that arrive as records: messages, JSON files, change logs, nested documents.

Field names on the wire are the column names of the targets.
"""

from __future__ import annotations

from ferryline.feeds.spec import FeedSpec, Field


def fields_of(text: str, default: str = "string") -> tuple[Field, ...]:
    """``name`` or ``name:type`` words to columns that keep their name."""
    return tuple(
        Field(name, kind or default, name, kind or default)
        for name, _, kind in (word.partition(":") for word in text.split())
    )


# Columns of sensor messages.
SENSOR = "pilot_id:bigint task_id:bigint device_id:bigint timestamp:timestamp"
EEG_EMG = " ".join(
    [SENSOR, "sampling_rate"]
    + [f"channel_{i}" for i in range(1, 11)]
    + [f"emg_{i}" for i in range(1, 9)]
)
EYE_TRACKING = f"""{SENSOR}
    pupil_diameter_left_px pupil_diameter_left_mm pupil_diameter_right_px
    pupil_diameter_right_mm pupil_distance_left pupil_distance_right pupil_center_x_left
    pupil_center_y_left pupil_center_x_right pupil_center_y_right blank_left blank_right
    openness_left openness_right gaze_point_left_x gaze_point_left_y gaze_point_right_x
    gaze_point_right_y gaze_origin_left_x gaze_origin_left_y gaze_origin_left_z
    gaze_origin_right_x gaze_origin_right_y gaze_origin_right_z gaze_direction_left_x
    gaze_direction_left_y gaze_direction_left_z gaze_direction_right_x
    gaze_direction_right_y gaze_direction_right_z fixation_duration_us
    fixation_saccade_count fixation_saccade_state fixation_saccade_center_x
    fixation_saccade_center_y"""
JOINT_POSTURE = f"{SENSOR} joint_name:string qx qy qz qw px py pz"
ILLUMINANCE = "task_id:bigint device_id:bigint timestamp:timestamp illuminance"

# Columns of keyed records.
SORTIES_BATCH = "id batch_number"
SORTIES = """airplane_model airplane_number arm_type batch_number camp:bigint camp_str
    car_end_time:timestamp car_start_time:timestamp create_time:timestamp down_pilot
    folder_id folder_name icd_version interpolation:bigint is_effective:bigint
    is_effective_name location pilot qx_id remark role:bigint role_str sky_time sortie_id
    sortie_number source:bigint stealth:bigint stealth_str subject sync_system:bigint
    sync_system_str test_drive:bigint test_drive_str up_pilot"""
PERSONNEL = """unit_code unit personal_identifier name position sex appointment_date:date
    native_place family_background education_level birthday:date enlistment_date:date
    rating_date:date graduate_college graduation_date:date military_rank pilot_role
    flight_level current_aircraft_type pxh code_name bm code_character
    is_air_combat_commander flight_outline lead_pilot command_level_daytime
    command_level_nighttime instructor theoretical_instructor zbzt is_trainee
    is_instructor qb last_parachute_time_land:date last_parachute_time_water:date
    modification_time:date total_time_history total_time_current_year
    total_teaching_time_history"""

# The parts of a flight plan document.
PLAN_ROOT = "id flight_date:date flight_date_time:timestamp"
PLAN_HEAD = """ver title timeline t_mode plane_num:int flights_time:int total_time:int
    exit_time:int sun_rise_time sun_set_time dark_time dawn_time dxthh zhshh dwsbxh"""
PLAN_NOTES = "note"
PLAN_COMMAND = "name lb sx"
PLAN_TASK = "model code name rw"
PLAN_ITEM = """airport_id takeoff_time air_battle_time ys plane_model practice_number cs sj
    jhlx plan_time height ky fz formation_number is_leader_plane formation_practice
    number_of_formation front_name front_code front_code_name front_nick_name
    front_property back_name back_code back_code_name back_nick_name back_property xsms
    jkys yxyl wqgz grfa"""

# Asset metadata.
ASSET_SUMMARY = """id:bigint sortie_number name full_name model icd_id:int icd db_name
    source:smallint remark objectify_flag:int copy_flag:int labels time_frame:int
    time_type:int"""
ASSET_MODEL = """id:bigint sortie_number name asset_id:bigint icd_id:bigint is_master:int
    repeat_interval:int repeat_times:int"""
ASSET_PROPERTY = """sortie_number model_id:bigint code name type is_time:int
    two_d_display:int label"""

# Change-captured tables. ``a>b`` is stored under b, ``:t>u`` cast to u.
EQUIPMENT_CODE = """id create_people>creator create_time:timestamp update_people>modifier
    update_time>modification_time:timestamp old_id:int plane_old_id:int c_coat c_interior
    c_manufacturing icd_version arionics_system_version>avionics_system_version
    is_used:tinyint is_deleted:tinyint used_time:timestamp icd_version_id"""
EQUIPMENT_INFO = """id create_time:timestamp create_people>creator
    update_time>modification_time:timestamp update_people>modifier old_id:int plane_type
    equipment_type plane_weight:decimal>double parent_id threetype_system>_3d_system
    is_deleted:tinyint equipment_model unit work_band>working_frequency_band
    longitude:string>double latitude:string>double is_three_back>is_3d_playback:tinyint"""


def _mapped(text: str) -> tuple[Field, ...]:
    fields = []
    for word in text.split():
        names, _, kinds = word.partition(":")
        source, _, target = names.partition(">")
        kind, _, to = (kinds or "string").partition(">")
        fields.append(Field(source, kind, target or source, to or kind))
    return tuple(fields)


def _stream(code, table, database, text, source="message", default="double", **more):
    return FeedSpec(code, table, database, source, "append", fields_of(text, default), **more)


def _keyed(code, table, database, source, text, *keys, **more):
    return FeedSpec(code, table, database, source, "upsert", fields_of(text), keys, **more)


def _plan(code: str, source: str, targets: dict[str, str]) -> FeedSpec:
    return FeedSpec(
        code,
        "flight_plan_root",
        "flight_plan",
        source,
        "fan_out",
        fields_of(PLAN_ROOT),
        ("id",),
        options={"targets": targets},
    )


# Where each variant of a plan document goes.
PLAN_TARGETS = {"plan": "flight_plan"}
PLAN_VARIANTS = {
    "dynamic": "flight_plan_dynamic",
    "implementation": "flight_plan_implementation",
}

PLAN_PARTS = {
    "flight_head": fields_of(PLAN_HEAD),
    "flight_notes": fields_of(PLAN_NOTES),
    "flight_cmd": fields_of(PLAN_COMMAND),
    "flight_task": fields_of(PLAN_TASK),
    "flight_plan": fields_of(PLAN_ITEM),
}

ASSET_TABLES = [
    _keyed("F57", "asset_summary", "real_world_flight", "envelope", ASSET_SUMMARY, "id"),
    _keyed("F57", "asset_table_model", "real_world_flight", "envelope", ASSET_MODEL, "id"),
    FeedSpec(
        "F57",
        "asset_table_property",
        "real_world_flight",
        "envelope",
        "delete_insert",
        fields_of(ASSET_PROPERTY),
        ("model_id", "sortie_number", "code"),
    ),
]

RECORD_FEEDS = [
    _stream("F44", "eeg_emg", "physiological", EEG_EMG),
    _stream("F45", "eye_tracking", "physiological", EYE_TRACKING),
    _stream("F46", "joint_posture", "physiological", JOINT_POSTURE, "message_array"),
    _stream("F47", "illuminance", "environment", ILLUMINANCE),
    _keyed(
        "F48", "sorties_batch", "sorties", "message", SORTIES_BATCH, "id",
        control_key="batch_number",
    ),
    _keyed(
        "F49", "sorties", "sorties", "message", SORTIES, "sortie_id",
        control_key="sortie_number",
    ),
    _keyed("F50", "personnel_info", "personnel", "message", PERSONNEL, "personal_identifier"),
    _keyed("F51", "personnel_info", "personnel", "json_array", PERSONNEL, "personal_identifier"),
    _plan("F52", "message", PLAN_TARGETS),
    _plan("F53", "json_array", PLAN_TARGETS),
    _plan("F54", "json_array", PLAN_VARIANTS),
    FeedSpec(
        "F55", "equipment_code", "equipment", "changelog", "replicate",
        _mapped(EQUIPMENT_CODE), ("id",), lineage=(),
    ),
    FeedSpec(
        "F56", "equipment_info", "equipment", "changelog", "replicate",
        _mapped(EQUIPMENT_INFO), ("id",), lineage=(),
    ),
]
