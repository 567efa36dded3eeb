"""Protocol numbers and lookup values shared by the whole package."""

# --- fixed values: packet codes (RFC 2865, RFC 2866, RFC 5176) ---
CODE_NAMES = {
    1: "Access-Request",
    2: "Access-Accept",
    3: "Access-Reject",
    4: "Accounting-Request",
    5: "Accounting-Response",
    11: "Access-Challenge",
    40: "Disconnect-Request",
    41: "Disconnect-ACK",
    42: "Disconnect-NAK",
    43: "CoA-Request",
    44: "CoA-ACK",
    45: "CoA-NAK",
}
ACCESS_REQUEST, ACCESS_ACCEPT, ACCESS_REJECT = 1, 2, 3
ACCOUNTING_REQUEST, ACCOUNTING_RESPONSE, ACCESS_CHALLENGE = 4, 5, 11
AUTH_RESPONSE_CODES = [2, 3, 11]
CONTROL_CODES = [40, 41, 42, 43, 44, 45]

# --- fixed values: accounting status types (RFC 2866) ---
ACCT_START, ACCT_STOP, ACCT_INTERIM = 1, 2, 3
ACCT_DEVICE_STATUSES = [7, 8, 15]
ACCT_RESTART_STATUSES = [7, 8]

# --- fixed values: attribute type numbers (RFC 2865, 2866, 2869, 5176) ---
ATTR_USER_NAME = 1
ATTR_NAS_IP = 4
ATTR_NAS_PORT = 5
ATTR_SERVICE_TYPE = 6
ATTR_FRAMED_PROTOCOL = 7
ATTR_FRAMED_IP = 8
ATTR_FRAMED_IP_NETMASK = 9
ATTR_REPLY_MESSAGE = 18
ATTR_CLASS = 25
ATTR_VENDOR_SPECIFIC = 26
ATTR_CALLED_STATION = 30
ATTR_CALLING_STATION = 31
ATTR_NAS_IDENTIFIER = 32
ATTR_ACCT_STATUS_TYPE = 40
ATTR_ACCT_DELAY_TIME = 41
ATTR_ACCT_INPUT_OCTETS = 42
ATTR_ACCT_OUTPUT_OCTETS = 43
ATTR_ACCT_SESSION_ID = 44
ATTR_ACCT_AUTHENTIC = 45
ATTR_ACCT_SESSION_TIME = 46
ATTR_ACCT_INPUT_PACKETS = 47
ATTR_ACCT_OUTPUT_PACKETS = 48
ATTR_ACCT_TERMINATE_CAUSE = 49
ATTR_ACCT_MULTI_SESSION_ID = 50
ATTR_ACCT_INPUT_GIGAWORDS = 52
ATTR_ACCT_OUTPUT_GIGAWORDS = 53
ATTR_EVENT_TIMESTAMP = 55
ATTR_NAS_PORT_TYPE = 61
ATTR_CONNECT_INFO = 77
ATTR_NAS_PORT_ID = 87
ATTR_ERROR_CAUSE = 101

# --- fixed values: vendor-specific sub-attributes read by the decoder ---
VENDOR_ID = 2011
VSA_INPUT_AVERAGE_RATE = 1
VSA_OUTPUT_AVERAGE_RATE = 2
VSA_PRODUCT_ID = 22
VSA_SUBSCRIBER_ID = 138
VSA_MAC_ADDRESS = 153

# --- fixed values: reply message -> (reason, risk level) ---
REPLY_REASONS = {
    "006:Search Err or User not exists": ("账号不存在", "high"),
    "020:Your loginname have Non-printable Character": ("账号含非法字符", "medium"),
    "002:Your password is error , please check": ("密码错误", "medium"),
    "018:User not any subscription": ("账号未订购服务", "low"),
    "007:User State Err": ("账号状态异常", "medium"),
    "014:User subscription Time error": ("订购时间异常", "low"),
}
RISK_UNKNOWN = "unknown"
UNMATCHED_USER = "(未匹配)"

# --- fixed values: service ports ---
CAPTURE_PORTS = [1812, 1813, 3799]

# --- fixed values: retention in days per table ---
RETAIN_DAYS = {
    "auth_log": 30,
    "acct_log": 30,
    "auth_user_10m": 1,
    "auth_user_mac_10m": 3,
    "aaa_events": 180,
    "collector_metrics": 365,
    "auth_rollup_states": 400,
    "acct_rollup_1h": 400,
}

COUNTER_SCALE = 1024
PAIRING_TTL_SECONDS = 30
INTERIM_INTERVAL_SECONDS = 60
SPAN_GAP_MINUTES = 10
DEDUP_HOURS = 6
SESSION_STATE_DAYS = 2

# --- fixed values: unified event columns, in table order ---
EVENT_TEXT_COLUMNS = [
    "username", "raw_username", "subscriber_id", "nas_ip", "nas_identifier", "nas_port_id",
    "calling_sta", "mac_addr", "called_sta", "framed_ip", "framed_ip_netmask", "class_attr",
    "src_ip", "dst_ip", "result", "reply_raw", "reason_zh", "risk", "acct_session_id",
    "acct_multi_session_id", "connect_info", "product_id",
]
EVENT_COLUMNS = [
    "event_id", "event_time", "event_type", "username", "raw_username", "subscriber_id",
    "nas_ip", "nas_identifier", "nas_port", "nas_port_id", "nas_port_type",
    "service_type", "framed_protocol", "calling_sta", "mac_addr", "called_sta",
    "framed_ip", "framed_ip_netmask", "class_attr",
    "src_ip", "dst_ip", "src_port", "dst_port", "packet_identifier",
    "result_code", "result", "reply_raw", "reason_zh", "risk",
    "acct_status_type", "acct_session_id", "acct_multi_session_id",
    "acct_authentic", "acct_session_time", "connect_info", "error_cause",
    "input_total", "output_total", "input_delta", "output_delta",
    "input_packets", "output_packets", "terminate_cause", "event_timestamp",
    "acct_delay_time", "input_average_rate", "output_average_rate", "product_id",
    "counter_rollback",
]
