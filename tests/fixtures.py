"""Sample documents, written as landed files."""

import json
from pathlib import Path

STAMP = "20260730T140512Z"


def land(folder, name, document, historical=False):
    target = Path(folder) / ("historical" if historical else "") / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(document if isinstance(document, str) else json.dumps(document))
    return str(folder)


def weather(days, tmax, tmin=(), rain=(), wind=(), code=()):
    return {
        "daily": {
            "time": list(days),
            "temperature_2m_max": list(tmax),
            "temperature_2m_min": list(tmin),
            "precipitation_sum": list(rain),
            "wind_speed_10m_max": list(wind),
            "weather_code": list(code),
        }
    }


def cme(event_id, analyses=None, start="2026-07-20T12:34Z", **more):
    return {"activityID": event_id, "startTime": start, "cmeAnalyses": analyses, **more}


def approach(asteroid_id, day, km, kph=1000, diameter=10.5, name="A", hazard=True, extra=()):
    return {
        "id": asteroid_id,
        "name": name,
        "is_potentially_hazardous_asteroid": hazard,
        "estimated_diameter": {"meters": {"estimated_diameter_max": diameter}},
        "close_approach_data": [
            {
                "close_approach_date": day,
                "miss_distance": {"kilometers": str(km)},
                "relative_velocity": {"kilometers_per_hour": str(kph)},
            },
            *extra,
        ],
    }
