"""Landing of dumps, exports, and the shared folder used between stages."""
