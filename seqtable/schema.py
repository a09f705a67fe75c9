"""Explicit schemas of the record types, as column name -> Spark SQL type."""

ACTION_TYPES_BY_COLUMN = {
    "timestamp": "DOUBLE",  # milliseconds
    "action_type": "STRING",
    "action_id": "STRING",
    "element_type": "STRING",
    "element_selector": "STRING",
    "url": "STRING",
    "page_title": "STRING",
    "element_text": "STRING",
    "element_id": "STRING",
    "element_classes": "ARRAY<STRING>",
    "value": "STRING",
    "option_index": "INT",
    "coordinates": "STRUCT<x: INT, y: INT>",
    "is_intentional": "BOOLEAN",
    "confidence": "DOUBLE",
    "user_intent": "STRING",
    "dom_snapshot": "STRING",
    "element_visible": "BOOLEAN",
    "element_clickable": "BOOLEAN",
    "session_id": "STRING",
    "tab_id": "STRING",
    "frame_id": "STRING",
}
ACTION_COLUMNS = list(ACTION_TYPES_BY_COLUMN)
ACTION = ", ".join(f"{name}: {kind}" for name, kind in ACTION_TYPES_BY_COLUMN.items())

# A trajectory as stored: 14 attributes and 4 measures derived from the actions.
TRAJECTORY_TYPES_BY_COLUMN = {
    "trajectory_id": "STRING",
    "session_id": "STRING",
    "actions": f"ARRAY<STRUCT<{ACTION}>>",
    "workflow_type": "STRING",
    "domain": "STRING",
    "start_time": "DOUBLE",  # milliseconds
    "end_time": "DOUBLE",  # milliseconds
    "duration": "DOUBLE",  # seconds
    "user_type": "STRING",
    "device_type": "STRING",
    "browser_type": "STRING",
    "goal": "STRING",
    "goal_achieved": "BOOLEAN",
    "success_indicators": "ARRAY<STRING>",
    "action_count": "INT",
    "avg_action_interval": "DOUBLE",
    "backtrack_count": "INT",
    "error_count": "INT",
}
TRAJECTORY = ", ".join(f"{name} {kind}" for name, kind in TRAJECTORY_TYPES_BY_COLUMN.items())

# Trajectory attributes repeated on every row of the stored flat table.
FLAT_HEADER = ["workflow_type", "domain", "user_type", "goal", "goal_achieved"]
