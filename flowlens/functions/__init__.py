from flowlens.functions.packet import (  # noqa: F401
    class_name,
    clip,
    dst_port,
    flag,
    flow_id,
    proto_num,
    src_port,
    time_bin,
    time_label,
)
