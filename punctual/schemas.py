"""Pinned schemas of the inputs. Unknown keys are dropped and missing keys read as
NULL, so a new field in the source cannot break a load."""

STATION = """
    stationShortCode string, stationName string, stationUICCode int,
    latitude double, longitude double, passengerTraffic boolean,
    type string, countryCode string
"""

CAUSE = """
    categoryCode: string, categoryCodeId: bigint,
    detailedCategoryCode: string, detailedCategoryCodeId: bigint,
    thirdCategoryCode: string, thirdCategoryCodeId: bigint
"""

TIMETABLE_ROW = f"""
    type: string, commercialTrack: string, cancelled: boolean,
    scheduledTime: string, actualTime: string, differenceInMinutes: bigint,
    commercialStop: boolean, causes: array<struct<{CAUSE}>>,
    stationShortCode: string, stationUICCode: bigint, countryCode: string,
    trainReady: struct<accepted: boolean, source: string, timestamp: string>,
    trainStopping: boolean, liveEstimateTime: string, estimateSource: string,
    stopSector: string, unknownDelay: boolean, unknownTrack: boolean
"""

TRAIN = f"""
    trainNumber int, departureDate date, operatorUICCode int, operatorShortCode string,
    trainType string, trainCategory string, commuterLineID string,
    runningCurrently boolean, cancelled boolean, version bigint,
    timetableType string, timetableAcceptanceDate timestamp_ntz,
    timeTableRows array<struct<{TIMETABLE_ROW}>>
"""

WEATHER = """
    date date, city string, temperature_c double, precipitation_mm double,
    wind_speed_kmh double, snow_depth_cm int, conditions string
"""

WEATHER_ARCHIVE = """
    date date, station_code string, temp_avg_c double, temp_min_c double, temp_max_c double,
    precipitation_mm double, snow_depth_cm int, wind_speed_kmh double, visibility_km double
"""

STATION_ATTRIBUTES = """
    station_code string, population_nearby bigint, platforms int, has_restaurant string,
    parking_spaces int, elevation_m int, region string
"""

INCIDENT = """
    incident_id string, date date, train_number bigint, station string, delay_minutes bigint,
    category string, subcategory string, weather_related boolean, resolved_time_minutes bigint,
    impact struct<affected_trains: bigint, total_delay_minutes: bigint>
"""

ROUTE = """
    route_id string, route_name string, origin string, destination string, distance_km int,
    typical_duration_min int, stops int, train_types string
"""
