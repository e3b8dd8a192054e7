"""CSV feeds. Column order on file is fixed by the producers; the header row is skipped.

Names of target columns follow from the names on file (``snake_case``), types from
the rules below.
"""

from __future__ import annotations

from ferryline.feeds.spec import FeedSpec, Field

# Columns that are not text, by domain. All others are text in
# simulation feeds and DOUBLE in sensor feeds.
SIMULATION_TYPES = {
    "messageTime": "time",
    "satelliteGuidanceTime": "time",
    "localTime": "time",
    "endTime": "time",
    "messageSequenceNumber": "bigint",
    "responseSequenceNumber": "bigint",
    "responseMessageSequenceNumber": "bigint",
}
SENSOR_TYPES = {
    "taskId": "bigint",
    "deviceId": "bigint",
    "pilotId": "bigint",
    "timestamp": "timestamp",
}

# Columns most messages start with, after the id of the sender.
CLOCK = "messageTime satelliteGuidanceTime localTime messageSequenceNumber"
AIR = f"aircraftId {CLOCK}"
GROUND = f"groundDefenseId {CLOCK}"
WORN = "taskId deviceId pilotId timestamp"

# Columns a missile track ends with.
TRACK = "longitude latitude altitude missileTargetDistance missileSpeed interceptionStatus"
SEEKER = "nonInterceptionReason seekerAzimuth seekerElevation targetTspiStatus commandMachineStatus"
GATES = "groundAngleSatisfactionFlag zeroCrossingFlag"
POSITION = "longitude latitude pressureAltitude roll pitch heading satelliteAltitude"
SPEEDS = "trainingStatus chaff afterburner northVelocity verticalVelocity eastVelocity"
LAUNCH = (
    "targetId interceptedWeaponId targetRealOrVirtual weaponId pylonId weaponType "
    "trajectoryType missileAttackMode"
)
PLANE = "aircraftId aircraftCallsign aircraftCodeName redBlueAffiliation flightBatch"

# The slots of a target report: eight times the same five columns.
TARGETS = " ".join(
    f"identifier{i} sensor{i} pitch{i} azimuth{i} slantRange{i}" for i in range(1, 9)
)

# Simulation feeds, table name and columns on file in order. A column in
# parentheses is on file but not stored.
SIMULATION = {
    "F01 aa_traj": f"""{AIR} weaponId (weaponPylonId) (aircraftLongitude) (aircraftLatitude)
        (aircraftAltitude) (weaponLongitude) (weaponLatitude) (weaponAltitude)
        (missileLongitude) (missileLatitude) (missileAltitude) (missileHeading)
        (missilePitch) (missileRoll) pylonId weaponType targetId {TRACK} {SEEKER} {GATES}""",
    "F02 ag_rtsn": f"""{AIR} weaponId weaponPylonId weaponType numberOfMissilesReleased
        aircraftGroundSpeed aircraftLongitude aircraftLatitude aircraftAltitude
        aircraftHeading aircraftPitch aircraftRoll aircraftAngleOfAttack aircraftNorthSpeed
        aircraftVerticalSpeed aircraftEastSpeed northWindSpeed verticalWindSpeed
        eastWindSpeed targetLongitude targetLatitude targetAltitude targetDistance
        seekerHeadNumber targetCoordinateValidity targetAzimuthElevationValidity
        targetElevationAngle targetAzimuthAngle impactAngleValidity entryAngle impactAngle
        directionValidity""",
    "F03 ag_traj": f"""{AIR} weaponId weaponType longitude latitude altitude heading pitch
        northSpeed skySpeed eastSpeed seekerId interceptionFlag terminationFlag
        interceptingMemberId interceptingEquipmentId interceptingEquipmentType launcherId
        seekerAzimuthCenter seekerPitchCenter targetId missileTargetDistance""",
    "F04 cd_drone_plane_state": f"""{AIR} trueAngleOfAttack machNumber normalLoadFactor
        indicatedAirspeed fieldElevation radioAltitude remainingFuel manualRespawn
        parameterSettingStatus""",
    "F05 cd_drone_tspi": f"aircraftId aircraftType {CLOCK} {POSITION} {SPEEDS} delayStatus",
    "F06 cmb_power": f"""{GROUND} availableMissileCount availableTargetChannelCount
        trainingMode allowMissileReset autoRespawn""",
    "F07 command": f"{AIR} commandType commandId commandContent responseSequenceNumber",
    "F08 eo_state": f"{AIR} workingMode powerStatus standbyStatus",
    "F09 error_data": """senderId messageTime localTime messageSequenceNumber messageId
        messageLength errorMessage""",
    "F10 ews": f"""{AIR} leftFrontJamming rightFrontJamming leftRearJamming
        rightRearJamming podForwardJamming podRearwardJamming""",
    "F11 ews_kj500": f"""{AIR} azimuthStartAngle sectorReference sectorType sectorNumber
        actionCode azimuthEndAngle""",
    "F12 ews_y8g": f"""{AIR} xBandJammingElevation cBandJammingElevation
        cBandJammingAzimuth sBandJammingElevation sBandJammingAzimuth lBandJammingElevation
        lBandJammingAzimuth uBandJammingAzimuth jammingStatus xBandJammingAzimuthAngle""",
    "F13 ews_y9t": f"""{AIR} jammingAzimuth jammingFrequencyCount jammingType jammingBand
        jammingDirection jammingStatus jammingElevation jammingStartFrequency
        jammingEndFrequency""",
    "F14 ews_yz8": f"""{AIR} workingStatus omnidirectionalDetectionQ1
        omnidirectionalDetectionQ2 preciseDirectionFindingJ1 preciseDirectionFindingJ2
        preciseDirectionFindingJ3 highGainG1 highGainG2""",
    "F15 g_tspi_back": f"{GROUND} responseMessageSequenceNumber",
    "F16 g_tspi": f"""{GROUND} campType equipmentType equipmentId status northAngle
        longitude latitude altitude decoyPositionId""",
    "F17 hj_plane_data": """localBatchNumber deviceNumber flightControlNumber localTime
        messageTime messageSequenceNumber longitude latitude altitude groundSpeed
        verticalSpeed heading""",
    "F18 hit_result": """launcherId targetId weaponType weaponId launchTime endTime
        hitResult""",
    "F19 ir_msl": f"{AIR} seekerAzimuth seekerElevation weaponType interceptionFlag",
    "F20 pl17_rtkn": f"""{AIR} weaponId weaponType targetId targetRealOrVirtual hitResult
        missReason missDistance matchingFailureReason jammingEffective jamming afterburner
        headOn heading pitch""",
    "F21 pl17_rtsn": f"{AIR} {LAUNCH}",
    "F22 pl17_traj": f"""{AIR} weaponId pylonId weaponType targetId {TRACK} {SEEKER} {GATES}
        distanceInterceptionFlag speedInterceptionFlag angleInterceptionFlag""",
    "F23 plane_pro": PLANE,
    "F24 plane_state": f"""{AIR} trueAngleOfAttack machNumber normalLoadFactor
        indicatedAirspeed fieldElevation radioAltitude remainingFuel scenario manualRespawn
        parameterSettingStatus encryptionStatus""",
    "F25 rdr_state": f"{AIR} workingMode airSeaScanRatio powerStatus emissionStatus",
    "F26 rtkn": f"""{AIR} weaponId weaponType targetId interceptedWeaponId hitResult
        missReason missDistance matchingFailureReason groundDefenseEquipmentType
        groundDefenseEquipmentId groundDefenseEquipmentType1 groundDefenseEquipmentId1
        groundDefenseEquipmentType2 groundDefenseEquipmentId2 groundDefenseEquipmentType3
        groundDefenseEquipmentId3 jammingEffective jamming afterburner headOn heading
        pitch""",
    "F27 rtsn": f"{AIR} {LAUNCH}",
    "F28 sa_tgt": f"""{GROUND} equipmentType equipmentNumber targetAzimuth targetElevation
        targetSlantRange channelNumber targetBatchNumber""",
    "F29 sa_traj": f"""{AIR} weaponId pylonId weaponType targetId interceptedWeaponId
        {TRACK} {SEEKER}""",
    "F30 sendto_3d_data": PLANE,
    "F31 srd_state": f"""{GROUND} campType equipmentType equipmentNumber powerOn
        emitterFrequencyBand decoyBlinkPeriod antennaPointing""",
    "F32 tgt": f"{AIR} targetCount {TARGETS}",
    "F33 tspi": f"aircraftId aircraftType {CLOCK} {POSITION} {SPEEDS}",
}

# Feeds of worn sensors and of the room. ``temperature`` of F39 stands at the
# position of the value column on file.
PHYSIOLOGICAL = {
    "F34 t_shirt_ecg_accel_gyro": f"""{WORN} ecg1 ecg2 ecg3 accelX accelY accelZ gyroX gyroY
        gyroZ""",
    "F35 t_shirt_heart_rate": f"{WORN} heartRate",
    "F36 t_shirt_hrv": f"""{WORN} rrMean averageHeartRate sdnn rmssd pnn50 sd1 sd2 sd1rsd2 apen
        lfNorm hfNorm lfrhf hf lf vlf ulf ttlpwr rsa""",
    "F37 t_shirt_resp": f"{WORN} respData",
    "F38 t_shirt_respiratory_rate": f"{WORN} respiratoryRate",
    "F39 t_shirt_temp": f"{WORN} temperature",
    "F40 wristband_spo2": f"{WORN} spo2",
    "F41 wristband_gsr": f"{WORN} gsrData",
    "F42 wristband_ppg_accel": f"""{WORN} ppgRed1 ppgRed2 ppgRed3 ppgRed4 ppgInfrared1
        ppgInfrared2 ppgInfrared3 ppgInfrared4 accelX accelY accelZ""",
}
ENVIRONMENT = {"F43 temperature_humidity": "taskId deviceId timestamp temperature humidity"}


def _simulation_field(word: str) -> Field:
    name = word.strip("()")
    return Field.of(name, SIMULATION_TYPES.get(name, "string"), stored=name == word)


def _sensor_field(name: str) -> Field:
    other = "string" if name.startswith("ppg") else "double"
    return Field.of(name, SENSOR_TYPES.get(name, other))


def _feeds(columns, database, field, mode, lineage) -> list[FeedSpec]:
    return [
        FeedSpec(
            code=key.split()[0],
            table=key.split()[1],
            database=database,
            source="csv",
            mode=mode,
            fields=tuple(field(word) for word in text.split()),
            lineage=lineage,
        )
        for key, text in columns.items()
    ]


CSV_FEEDS = (
    _feeds(
        SIMULATION,
        "simulation",
        _simulation_field,
        "replace_batch",
        ("import_id", "batch_number"),
    )
    + _feeds(PHYSIOLOGICAL, "physiological", _sensor_field, "append", ("import_id",))
    + _feeds(ENVIRONMENT, "environment", _sensor_field, "append", ("import_id",))
)
