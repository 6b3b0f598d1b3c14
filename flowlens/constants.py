"""Fixed values that must equal the reference pipeline's for equal results.

FIXED VALUES (kept verbatim, in their natural order):
"""

# Random seed used for sampling and model fits.
RANDOM_SEED = 42

# Default DDoS labelling rule: source, destination, first and last second (both inclusive).
DDOS_SRC = "10.0.0.5"
DDOS_DST = "10.0.0.3"
DDOS_T_START = 196.0
DDOS_T_END = 235.0

# Row cap of the PortScan capture (first N file rows, before cleaning).
PORTSCAN_NROWS = 300_000

# Class id -> name.
CLASS_NAMES = {
    0: "Normal",
    1: "DDoS",
    2: "PortScan",
    3: "Fuzzer",
    4: "BruteForce",
}

# Protocol display name -> number (exact case); anything else maps to 0.
PROTOCOL_MAP = {
    "ICMP": 1,
    "TCP": 6,
    "UDP": 17,
    "ICMPv6": 58,
    "ARP": 2054,
    "OpenFlow": 6653,
    "DNS": 53,
    "MDNS": 5353,
    "HTTP": 80,
}

# TCP flags searched (case-sensitive substring) in the Info column.
TCP_FLAGS = ["SYN", "ACK", "FIN", "RST", "PSH", "URG"]

# Port pattern: first "<digits> > <digits>" anywhere in Info.
PORT_PATTERN = r"(\d+)\s*>\s*(\d+)"

# Count windows: packets per window and slide.
WINDOW_SIZE = 100
STEP_SIZE = 10

# Downsampling defaults.
DOWNSAMPLE_FRAC = 0.1
DOWNSAMPLE_MIN_KEEP = 500_000
DOWNSAMPLE_LABELS = [0, 1, 4]

# Per-class temporal split.
TRAIN_FRACTION = 0.70

# Model input columns, in this order.
FEATURE_COLS = [
    "pkt_count", "byte_total", "byte_mean", "byte_std", "byte_min", "byte_max",
    "pkt_rate", "byte_rate", "flow_duration",
    "IAT_mean", "IAT_std", "IAT_min", "IAT_max", "IAT_total",
    "SYN_count", "ACK_count", "FIN_count", "RST_count", "PSH_count",
    "syn_ratio", "ack_ratio", "fin_ratio", "rst_ratio", "psh_ratio",
    "syn_no_ack", "n_unique_src", "n_unique_dst", "n_unique_flows",
    "n_unique_dports", "n_unique_sports", "protocol_entropy",
]

# Capture names in timeline order, with the constant label of the pure captures.
CAPTURE_ORDER = ["DDoS-TCP", "PortScan", "Fuzzer", "BruteForce"]
CAPTURE_CONST_LABEL = {"PortScan": 2, "Fuzzer": 3, "BruteForce": 4}

# Decision-rule search grids: 19 thresholds 0.05..0.95 and 31 biases -3..3.
THRESHOLD_GRID = (0.05, 0.95, 19)
BIAS_GRID = (-3.0, 3.0, 31)

# Alert throttle (seconds between emitted alerts) and dashboard timeline length.
ALERT_COOLDOWN_S = 3.0
TIMELINE_LEN = 120
SNAPSHOT_EVERY = 5

# Dashboard summary: features shown per class and the histogram clip percentile.
SUMMARY_STAT_FEATURES = ["pkt_rate", "syn_ratio", "IAT_min", "n_unique_dports", "n_unique_src"]
SUMMARY_HIST_FEATURES = ["pkt_rate", "syn_ratio", "IAT_min", "n_unique_dports"]
SUMMARY_HIST_BINS = 30
SUMMARY_CLIP_PCT = 0.98
SUMMARY_SAMPLE = 500

# Label leakage check threshold.
LEAKAGE_THRESHOLD = 0.85

# Emulated network hosts: name, ip, mac, switch, role (20 rows).
HOSTS = [
    ("h1", "10.0.0.1", "00:00:00:00:00:01", 2, "server"),
    ("h2", "10.0.0.2", "00:00:00:00:00:02", 2, "normal"),
    ("h3", "10.0.0.3", "00:00:00:00:00:03", 2, "normal"),
    ("h4", "10.0.0.4", "00:00:00:00:00:04", 2, "normal"),
    ("h5", "10.0.0.5", "00:00:00:00:00:05", 2, "normal"),
    ("h6", "10.0.0.6", "00:00:00:00:00:06", 3, "background"),
    ("h7", "10.0.0.7", "00:00:00:00:00:07", 3, "background"),
    ("h8", "10.0.0.8", "00:00:00:00:00:08", 3, "background"),
    ("h9", "10.0.0.9", "00:00:00:00:00:09", 3, "background"),
    ("h10", "10.0.0.10", "00:00:00:00:00:0a", 3, "background"),
    ("h11", "10.0.0.11", "00:00:00:00:00:0b", 4, "normal"),
    ("h12", "10.0.0.12", "00:00:00:00:00:0c", 4, "normal"),
    ("h13", "10.0.0.13", "00:00:00:00:00:0d", 4, "normal"),
    ("h14", "10.0.0.14", "00:00:00:00:00:0e", 4, "normal"),
    ("h15", "10.0.0.15", "00:00:00:00:00:0f", 4, "normal"),
    ("h16", "10.0.0.16", "00:00:00:00:00:10", 5, "normal"),
    ("h17", "10.0.0.17", "00:00:00:00:00:11", 5, "normal"),
    ("h18", "10.0.0.18", "00:00:00:00:00:12", 5, "ATTACKER"),
    ("h19", "10.0.0.19", "00:00:00:00:00:13", 5, "ATTACKER"),
    ("h20", "10.0.0.20", "00:00:00:00:00:14", 5, "ATTACKER"),
]
