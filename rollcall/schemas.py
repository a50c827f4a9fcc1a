"""Schemas of the tables the engine reads and writes."""

RAW_LOGS = """address string, topics array<string>, data string, blockNumber string,
    transactionHash string, logIndex string"""

BLOCKS = "block_number bigint, block_time timestamp"

REGISTRATION_EVENTS = """event_type string, agent_id string, agent_id_hex string,
    block_number bigint, block_time timestamp, tx_hash string, log_index int, topic0 string,
    owner string, from_address string, agent_uri string, metadata_key string,
    metadata_value string, raw_topics array<string>, raw_data string, ingested_at timestamp"""

AGENTS = """agent_id string, owner string, minted_to string, transfer_count int,
    registered_block bigint, registered_at timestamp, registered_tx string,
    uri_at_registration string, current_uri string, current_uri_block bigint,
    current_uri_log_index int, uri_change_count int, uri_host string, uri_root_domain string,
    in_panel boolean, panel_added_at timestamp, panel_stratum string"""

CHECK_RUNS = """id bigint, kind string, status string, started_at timestamp,
    finished_at timestamp, agents_planned int, agents_checked int, concurrency int,
    timeout_seconds decimal(6,2), user_agent string, prober_version string, notes string"""

# One row per attempt of the crawler to fetch an agent's document.
FETCHES = """run_id bigint, agent_id string, pass int, pos int, target string, excluded boolean,
    robots_allowed boolean, status int, error_class string, error_message string,
    latency_ms int, content_type string, bytes int, body string"""

# One row per request to a declared endpoint: HEAD, and GET where HEAD did not do.
ENDPOINT_PROBES = """run_id bigint, agent_id string, pass int, pos int, url string,
    method string, excluded boolean, robots_allowed boolean, status int, error_class string,
    error_message string, latency_ms int"""

ENDPOINT_DETAILS = """array<struct<url:string,host:string,ok:boolean,status:string,
    latency_ms:int,generic:boolean>>"""

EXCLUDED_HOSTS = "host string, reason string, requested_by string, added_at timestamp"

PROGRESS = """stream string, batch_id bigint, last_block bigint, tip bigint, events bigint,
    inserted bigint, agents bigint, sanitized bigint, unreadable bigint, status string,
    error string, run_at timestamp"""

# What a set of events says about an agent; rows of disjoint sets merge.
PARTIAL_STATES = """agent_id string, reg struct<block_number: bigint, log_index: int,
    owner: string, agent_uri: string, block_time: timestamp, tx_hash: string>,
    uri struct<block_number: bigint, log_index: int, agent_uri: string>,
    hold struct<block_number: bigint, log_index: int, owner: string>, uri_changes bigint,
    transfers bigint, registrations bigint"""
