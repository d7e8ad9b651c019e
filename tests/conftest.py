import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from flowlens import get_session
    s = get_session(master="local[4]", shuffle_partitions=8)
    yield s


PACKET_DDL = ("arrival_seq long, ts double, src_ip string, dst_ip string, proto string, "
              "sport int, dport int, payload_len int, pkt_len int")

# FIXTURES.md §2, worked by hand
FIXTURE_PACKETS = [
    (1, 100.00, "10.0.0.1", "10.0.0.2", "tcp", 50000, 80, 0, 60),
    (2, 100.02, "10.0.0.2", "10.0.0.1", "tcp", 80, 50000, 0, 60),
    (3, 100.01, "10.0.0.1", "10.0.0.2", "tcp", 50000, 80, 100, 160),
    (4, 100.05, "10.0.0.2", "10.0.0.1", "tcp", 80, 50000, 200, 260),
    (5, 99.90, "10.0.0.1", "10.0.0.2", "tcp", 50000, 80, 0, 60),
    (6, 100.10, "10.0.0.3", "10.0.0.4", "tcp", 51000, 23, 0, 60),
    (7, 100.20, "10.0.0.5", "10.0.0.6", "icmp", 0, 0, 0, 60),
    (8, 100.21, "10.0.0.6", "10.0.0.5", "icmp", 0, 0, 0, 60),
    (9, 100.25, "10.0.0.7", "10.0.0.8", "other", 1, 2, 5, 65),
    (10, 100.26, None, None, "tcp", 1, 2, 5, 65),
    (11, 100.30, "10.0.0.9", "10.0.0.9", "udp", 53, 53, 10, 70),
]
