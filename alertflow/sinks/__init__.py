"""Writers: prediction stores and message topics."""
