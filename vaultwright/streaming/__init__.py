from vaultwright.streaming.sinks import load_chain_stream, load_stream

__all__ = ["load_chain_stream", "load_stream"]
