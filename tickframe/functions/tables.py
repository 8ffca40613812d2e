"""Word lists, aliases, labels and patterns that results depend on."""

# --- fixed values -----------------------------------------------------------------------------------------------

OS_KEYS = [
    "cmd", "cmd_l", "cmd_r", "win", "win_l", "win_r", "super", "super_l", "super_r", "lwin", "rwin", "menu", "apps", "media_volume_up", "media_volume_down", "media_volume_mute",
    "volume_up", "volume_down", "volume_mute", "media_play_pause", "media_play", "media_pause", "media_next", "media_previous", "media_prev", "media_stop",
    "media_play_pause_button", "print_screen", "prtsc", "snapshot", "sys_req", "caps_lock", "num_lock", "scroll_lock", "insert", "pause", "break",
]
F_KEYS = [f"f{i}" for i in range(1, 25)]

LITERAL_ALIASES = {
    "leftshift": "shift_l", "lshift": "shift_l", "left shift": "shift_l",
    "rightshift": "shift_r", "rshift": "shift_r", "right shift": "shift_r",
    "leftctrl": "ctrl_l", "lctrl": "ctrl_l", "left ctrl": "ctrl_l", "control": "ctrl",
    "rightctrl": "ctrl_r", "rctrl": "ctrl_r", "right ctrl": "ctrl_r",
    "leftalt": "alt_l", "lalt": "alt_l", "left alt": "alt_l",
    "rightalt": "alt_r", "ralt": "alt_r", "right alt": "alt_r", "altgr": "alt_gr",
    "escape": "esc", "esc": "esc", "spacebar": "space", "space bar": "space", "space": "space",
    "return": "enter", "del": "delete", "ins": "insert", "pageup": "page_up", "page up": "page_up",
    "pagedown": "page_down", "page down": "page_down", "capslock": "caps_lock", "comma": ",",
    "mouseleft": "mouse_left", "mouseright": "mouse_right", "mousemiddle": "mouse_middle",
    "mouse4": "mouse_x1", "mouse5": "mouse_x2", "mousex": "mouse_x", "mousey": "mouse_y", "mouse": "mouse",
    "mousescrollup": "mouse_scroll_up", "mousescrolldown": "mouse_scroll_down",
}
VIRTUAL_KEY = r"^(vk_?[0-9]+|<[0-9]+>|0x[0-9a-f]+)$"
MOTION_LITERALS = ["mouse", "mouse_x", "mouse_y"]
MODIFIER_PAIRS = [("shift_l", "shift_r"), ("ctrl_l", "ctrl_r"), ("alt_l", "alt_r")]
KEY_DISPLAY = {
    "shift": "Shift", "shift_l": "LShift", "shift_r": "RShift", "ctrl": "Ctrl", "ctrl_l": "LCtrl", "ctrl_r": "RCtrl",
    "alt": "Alt", "alt_l": "LAlt", "alt_r": "RAlt", "alt_gr": "AltGr", "esc": "Esc", "space": "Space", "tab": "Tab",
    "enter": "Enter", "backspace": "Backspace", "delete": "Delete", "home": "Home", "end": "End", "page_up": "PageUp",
    "page_down": "PageDown", "up": "Up", "down": "Down", "left": "Left", "right": "Right", ",": "Comma",
}
BUTTON_DISPLAY = {"mouse_left": "Left", "mouse_right": "Right", "mouse_middle": "Middle", "mouse_x1": "X1", "mouse_x2": "X2"}
MODIFIER_ALTERNATES = {
    "shift": ["shift", "shift_l", "shift_r"], "shift_l": ["shift_l", "shift"], "shift_r": ["shift_r", "shift"],
    "ctrl": ["ctrl", "ctrl_l", "ctrl_r"], "ctrl_l": ["ctrl_l", "ctrl"], "ctrl_r": ["ctrl_r", "ctrl"],
    "alt": ["alt", "alt_l", "alt_r", "alt_gr"], "alt_l": ["alt_l", "alt"], "alt_r": ["alt_r", "alt"],
}
#: code: (label in batch reports, short label in daily reports)
REASON_LABELS = {
    "INP_MOTION_MISSING": ("no mouse motion", "no-mouse"), "INP_BUTTONS_MISSING": ("no mouse buttons", "no-buttons"),
    "INP_KEYS_MISSING": ("no keyboard", "no-keys"), "CNT_SHORT": ("<70s", "<70s"), "CNT_NOTIF_MID": ("notifications", "notifications"),
    "CNT_NOTIF_EDGE": ("notifications", "notifications"), "CNT_WRONG_GAME": ("wrong game", "wrong-game"), "INT_DUP_CROSS": ("duplicate", "dup"),
    "CNT_ACTIONS_FEW": ("<3 actions", "<3-actions"), "CNT_DROPS": ("frame drops", "drops"), "CNT_MID_NONGAMEPLAY": ("non-gameplay", "non-gameplay"),
    "CNT_AFK": ("AFK", "afk"), "CNT_CHAT_PII": ("chat/PII", "chat-pii"), "CNT_BLACK_FROZEN": ("black/frozen video", "black-frozen"),
    "SYN_UNMEASURABLE_SUSPECT": ("unverifiable sync", "sync-suspect"), "INT_TAMPER": ("integrity", "tamper"),
    "QA_FAIL_UNMAPPED": ("unmapped QA failure", "qa-unmapped"), "INT_PATH": ("bad drive path", "bad-path"),
}
#: substring of a check's message, and the reason it stands for; the first that fits wins
NEEDLES = [
    ("header != v2 schema", "STR_HEADER_BAD"), ("camera columns non-null", "STR_CAMERA_NONNULL"), ("not float-formatted", "STR_SENTINELS"),
    ("row count", "STR_ROWS_MISMATCH"), ("video frame count", "STR_ROWS_MISMATCH"), ("not strictly increasing", "STR_TS_NONMONO"),
    ("timestamp_ms[0]", "STR_TS_TAIL"), ("timestamp_ms[-1]", "STR_TS_TAIL"), ("non-v2 key tokens", "INP_TOKEN_CASE"),
    ("non-v2 mouse button", "INP_TOKEN_CASE"), ("input_keys but null input_actions", "INP_KEYS_NO_ACTION"), ("fan-out", "INP_FANOUT"),
    ("raw recomputation", "SYN_TS_NOT_PTS"), ("key_binding.json present", "ARR_V1_FORMAT"), ("missing required fields", "STR_SJ_INVALID"),
    ("not timezone-aware", "STR_SJ_INVALID"), ("ended_at_utc <=", "STR_SJ_INVALID"), ("duration_ms", "STR_SJ_INVALID"),
    ("frame_count differs", "STR_SJ_INVALID"), ("localization", "STR_SJ_INVALID"), ("platform not in", "STR_SJ_INVALID"),
    ("input_mouse_convention", "STR_SJ_INVALID"), ("maps_to", "STR_SJ_INVALID"), ("camera mapping", "STR_SJ_INVALID"),
    ("non-camera mapping", "STR_SJ_INVALID"), ("video duration", "STR_SJ_INVALID"), ("!= record_*_px", "STR_SJ_INVALID"),
    ("session.json numeric fields malformed", "STR_SJ_INVALID"), ("session.json timestamps", "STR_SJ_INVALID"),
    ("session.json unreadable", "STR_SJ_INVALID"), ("session.json is not a JSON object", "STR_SJ_INVALID"),
    ("game_title not a string", "STR_SJ_INVALID"), ("timestamp_ms column unparseable", "STR_TS_NONMONO"),
]
NEEDLES_SKIPPED = ["frame-sync drift", "controls-to-video sync", "mouse motion missing", "under 70s"]
HARD_REASONS = [
    "SYN_UNMEASURABLE_SUSPECT", "INP_KEYS_MISSING", "INP_MOTION_MISSING", "INP_BUTTONS_MISSING", "CNT_SHORT", "CNT_ACTIONS_FEW", "CNT_DROPS", "CNT_NOTIF_MID", "CNT_BLACK_FROZEN",
    "CNT_WRONG_GAME", "INT_TAMPER", "INT_DUP_CROSS", "INT_PATH",
]
#: limits, in seconds, milliseconds or shares as named
MIN_CLIP_S, MIN_ACTIONS, AFK_MIN_S, GATE_PAD, KEEP_GATE_MAX_S = 70.0, 3, 30.0, 2, 5.0
LAG_TARGET_MS, LAG_HARD_MS, MIN_ACTIVE, MIN_CORRELATION, SMOOTHING = 50.0, 150.0, 0.02, 0.15, 8
TARGET_HOURS, PACE_ALARM_FACTOR = 500.0, 1.15
