"""Fixed values of the security domain: vocabularies, lookup tables, probabilities, messages.

Everything in this module is data that query results depend on; the logic using it lives in
``vigilake.functions`` and ``vigilake.operators``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: severities -------------------------------------------------------------
SEVERITY_ORDER = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]

FALCO_PRIORITY_SEVERITY = {
    "EMERGENCY": "CRITICAL",
    "ALERT": "CRITICAL",
    "CRITICAL": "CRITICAL",
    "ERROR": "HIGH",
    "WARNING": "MEDIUM",
    "NOTICE": "LOW",
    "INFO": "LOW",
    "DEBUG": "LOW",
}

# (lowest, highest, severity) of the 1..10 integer scale
KUBEARMOR_SEVERITY_BANDS = [(1, 3, "LOW"), (4, 6, "MEDIUM"), (7, 8, "HIGH"), (9, 10, "CRITICAL")]

# --- Fixed values: event types ------------------------------------------------------------
# Keywords are tried in this order; the first one contained in the rule name decides.
RULE_KEYWORD_EVENT_TYPE = [
    ("shell", "shell_execution"),
    ("sensitive", "sensitive_file_read"),
    ("escape", "container_escape"),
    ("outbound", "unexpected_network_connection"),
    ("crypto", "crypto_mining"),
    ("privilege", "privilege_escalation"),
    ("network", "network_anomaly"),
]

KUBEARMOR_OPERATION_EVENT_TYPE = {
    "process": "process_execution",
    "file": "file_access",
    "network": "network_connection",
}

EVENT_TYPE_FLAGS = [
    ("shell_execution", "has_shell_exec"),
    ("privilege_escalation", "has_privilege_esc"),
    ("sensitive_file_read", "has_file_access"),
    ("container_escape", "has_escape_attempt"),
]

# --- Fixed values: clean-event schema defaults --------------------------------------------
COLUMN_DEFAULTS = {
    "timestamp": None,
    "source": "unknown",
    "event_id": None,
    "pod": "unknown",
    "namespace": "unknown",
    "container_id": "unknown",
    "severity": "LOW",
    "event_type": "unknown",
    "syscall": "",
    "process": "",
    "mitre_technique": None,
}

BLANK_WHEN_NULL = [
    "pod", "namespace", "container_id", "syscall", "process", "mitre_technique",
    "net_src_ip", "net_dst_ip", "net_protocol",
]

ZERO_WHEN_BAD = ["net_src_port", "net_dst_port", "severity_numeric"]

# --- Fixed values: feature extraction -----------------------------------------------------
DEFAULT_WINDOW_SECONDS = 60
TOP_SYSCALLS = 20
TOP_BIGRAMS = 10
ENTROPY_EPSILON = 1e-10
HIGH_PORT = 1024
OFF_HOURS_FROM, OFF_HOURS_UNTIL = 22, 6

# --- Fixed values: ATT&CK container techniques (id, name, tactic, description) -------------
TECHNIQUES = [
    ("T1190", "Exploit Public-Facing Application", "initial_access",
     "Exploit vulnerability in internet-facing containerized service"),
    ("T1133", "External Remote Services", "initial_access",
     "Use external remote services to access containers"),
    ("T1078", "Valid Accounts", "initial_access",
     "Use compromised credentials to access containers"),
    ("T1609", "Container Administration Command", "execution",
     "Execute commands via container admin tools (kubectl exec)"),
    ("T1610", "Deploy Container", "execution",
     "Deploy a malicious container to execute code"),
    ("T1053.007", "Container Orchestration Job", "execution",
     "Abuse K8s Jobs/CronJobs for code execution"),
    ("T1204.003", "Malicious Image", "execution",
     "Trick user into running malicious container image"),
    ("T1098.006", "Additional Container Cluster Roles", "persistence",
     "Create new RBAC roles for persistent access"),
    ("T1525", "Implant Internal Image", "persistence",
     "Backdoor internal container registry images"),
    ("T1543.005", "Container Service", "persistence",
     "Create/modify container services for persistence"),
    ("T1611", "Escape to Host", "privilege_escalation",
     "Break out of container sandbox to host"),
    ("T1068", "Exploitation for Privilege Escalation", "privilege_escalation",
     "Exploit vulnerability to gain higher privileges"),
    ("T1612", "Build Image on Host", "defense_evasion",
     "Build container images on host to evade detection"),
    ("T1562.001", "Disable or Modify Tools", "defense_evasion",
     "Disable security monitoring tools"),
    ("T1070", "Indicator Removal", "defense_evasion",
     "Delete logs and artifacts to cover tracks"),
    ("T1036.005", "Match Legitimate Name", "defense_evasion",
     "Name malicious resources to match legitimate ones"),
    ("T1110", "Brute Force", "credential_access",
     "Attempt to access accounts via brute force"),
    ("T1528", "Steal Application Access Token", "credential_access",
     "Steal OAuth/API tokens from containers"),
    ("T1552.001", "Credentials In Files", "credential_access",
     "Search container filesystem for credentials"),
    ("T1552.007", "Container API", "credential_access",
     "Access K8s API credentials from pod service account"),
    ("T1613", "Container and Resource Discovery", "discovery",
     "Enumerate containers, pods, and cluster resources"),
    ("T1046", "Network Service Discovery", "discovery",
     "Scan network for running services and open ports"),
    ("T1069.003", "Cloud Groups", "discovery",
     "Discover cloud IAM groups and permissions"),
    ("T1550.001", "Application Access Token", "lateral_movement",
     "Use stolen tokens to move laterally"),
    ("T1485", "Data Destruction", "impact",
     "Destroy data in containers or persistent volumes"),
    ("T1499", "Endpoint Denial of Service", "impact",
     "DDoS against containerized services"),
    ("T1490", "Inhibit System Recovery", "impact",
     "Prevent system recovery mechanisms"),
    ("T1498", "Network Denial of Service", "impact",
     "Flood network to deny service"),
    ("T1496", "Resource Hijacking", "impact",
     "Hijack compute resources for cryptomining"),
]

EVENT_TYPE_TECHNIQUES = {
    "shell_execution": ["T1609", "T1059"],
    "sensitive_file_read": ["T1552.001", "T1552.007"],
    "container_escape": ["T1611"],
    "unexpected_network_connection": ["T1046", "T1041"],
    "crypto_mining": ["T1496"],
    "privilege_escalation": ["T1068", "T1611"],
    "network_anomaly": ["T1046", "T1499", "T1498"],
    "process_execution": ["T1609", "T1204.003"],
    "file_access": ["T1552.001", "T1070"],
}

LABEL_TECHNIQUES = {
    "ddos": ["T1499", "T1498"],
    "exfiltration": ["T1041", "T1048"],
    "lateral_movement": ["T1046", "T1550.001"],
    "crypto_mining": ["T1496"],
    "benign": [],
}

# --- Fixed values: kill chain and its Bayesian network ------------------------------------
STAGES = [
    "initial_access",
    "execution",
    "persistence",
    "privilege_escalation",
    "defense_evasion",
    "credential_access",
    "discovery",
    "lateral_movement",
    "impact",
]

# stage -> (parents, P(stage = 1) for each parent assignment); the last parent varies fastest
STAGE_PROBABILITIES = {
    "initial_access": ([], [0.3]),
    "execution": (["initial_access"], [0.1, 0.85]),
    "persistence": (["execution"], [0.05, 0.65]),
    "privilege_escalation": (["execution"], [0.08, 0.60]),
    "defense_evasion": (["privilege_escalation"], [0.10, 0.70]),
    "credential_access": (["discovery"], [0.12, 0.65]),
    "discovery": (["execution"], [0.15, 0.80]),
    "lateral_movement": (["discovery", "credential_access"], [0.05, 0.45, 0.50, 0.85]),
    "impact": (["lateral_movement"], [0.10, 0.75]),
}

# (lowest deepest-stage index, risk level), deepest first
STAGE_RISK = [(7, "CRITICAL"), (5, "HIGH"), (2, "MEDIUM"), (-1, "LOW")]

RISK_RECOMMENDATION = {
    "CRITICAL": "ISOLATE pod immediately and migrate workloads",
    "HIGH": "Apply restrictive NetworkPolicy and alert SOC",
    "MEDIUM": "Increase monitoring granularity and log collection",
    "LOW": "Continue normal monitoring",
}

# --- Fixed values: alerts and response ----------------------------------------------------
REQUIRED_ALERT_FIELDS = ["pod", "namespace", "threat_type", "confidence_score"]
CONFIDENCE_THRESHOLD = 0.85
DEFAULT_RISK = "MEDIUM"
HISTORY_SIZE = 100
HISTORY_VIEW = 20

RISK_ACTIONS = {
    "CRITICAL": ["isolate_pod", "cordon_node", "migrate_pods"],
    "HIGH": ["isolate_pod"],
    "MEDIUM": ["apply_audit_policy"],
    "LOW": ["log_only"],
}
FALLBACK_ACTIONS = ["log_only"]
SKIPPED_REASON = "response modules not available"

# Per-risk minimum confidence of the documented decision matrix (optional gate)
RISK_CONFIDENCE = {"CRITICAL": 0.95, "HIGH": 0.85, "MEDIUM": 0.70, "LOW": 0.0}

POLICY_PREFIX = "aiops-isolate-"
POLICY_POD_LABEL = "statefulset.kubernetes.io/pod-name"
POLICY_PURPOSE = "Automated threat isolation"

READY_REPLICAS = 2

# --- Fixed values: operational views ------------------------------------------------------
FALLBACK_TECHNIQUE = "T1190"
ANOMALY_FROM_CONFIDENCE = 0.9
ANOMALY_CUTOFF = 0.7
ACTION_DISPLAY = {
    "isolate_pod": "Isolation",
    "migrate_pods": "Migration",
    "cordon_node": "Migration",
    "apply_audit_policy": "Monitoring",
}
DEFAULT_ENTITIES = [
    "web-frontend-7d9f4",
    "api-gateway-3b2c8",
    "auth-service-5e1a6",
    "payment-svc-9c4d2",
    "user-db-primary-0",
]
SERIES_MINUTES = 24
EMPTY_DISTRIBUTION = ("Clean (No Attacks)", 1)
NO_RESPONSE_DETAILS = "Automated action taken based on risk level"

# (stage name, abbreviation, keyword looked for in the predicted tactic), in display order
PROGRESSION_STAGES = [
    ("Initial Access", "IA", "access"),
    ("Execution", "EX", "execution"),
    ("Persistence", "PE", "persistence"),
    ("Privilege Esc.", "PR", "privilege"),
    ("Defense Evasion", "DE", "evasion"),
    ("Discovery", "DI", "discovery"),
    ("Lateral Movement", "LM", "lateral"),
    ("Impact", "IM", "impact"),
]

# --- Fixed values: detection rules (name, priority, tags) and their word lists -------------
RULE_SHELL = ("Shell Spawned in Container (AIOps)", "WARNING",
              ["container", "shell", "mitre_execution", "T1609"])
RULE_SENSITIVE_FILE = ("Sensitive File Read in Container (AIOps)", "CRITICAL",
                       ["container", "filesystem", "mitre_credential_access", "T1552"])
RULE_ESCAPE = ("Container Escape via Procfs (AIOps)", "CRITICAL",
               ["container", "escape", "mitre_privilege_escalation", "T1611"])
RULE_OUTBOUND = ("Unexpected Outbound Connection (AIOps)", "WARNING",
                 ["container", "network", "mitre_discovery", "T1046"])
RULE_MINER = ("Crypto Mining Process in Container (AIOps)", "CRITICAL",
              ["container", "cryptomining", "mitre_impact", "T1496"])
RULE_PRIVILEGE = ("Privilege Escalation Attempt (AIOps)", "CRITICAL",
                  ["container", "privilege_escalation", "mitre_privilege_escalation", "T1068"])

SHELL_NAMES = ["bash", "sh", "zsh", "csh", "ksh", "dash"]
SHELL_PARENTS_ALLOWED = ["crond", "sshd"]
SENSITIVE_PATHS = ["/etc/shadow", "/etc/passwd", "/var/run/secrets", "/proc/self"]
ESCAPE_PATHS = ["/proc/1/root", "/proc/sysrq-trigger"]
ESCAPE_CALLS = ["setns", "unshare"]
INTERNAL_NAMES = ["cluster.local", "kube-dns.kube-system", "kubernetes.default"]
MINER_NAMES = ["xmrig", "minerd", "cpuminer", "ethminer", "cgminer"]
MINER_MARKERS = ["stratum+tcp", "mining.pool"]
SETID_CALLS = ["setuid", "setgid", "setreuid", "setresuid"]


def techniques_table(spark: SparkSession) -> DataFrame:
    """The technique dimension (a fixed 29 rows) with the kill-chain index of its tactic."""
    rows = [(t, n, tac, d, STAGES.index(tac)) for t, n, tac, d in TECHNIQUES]
    return spark.createDataFrame(
        rows, "technique_id string, technique_name string, tactic string, description string, stage_idx int"
    )
